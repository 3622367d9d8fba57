"""ITRANS romanization of eight Indic scripts, whose Unicode blocks share one layout."""

from __future__ import annotations

# Offsets within a block (as in Devanagari) and their ITRANS letters.
_VOWELS = dict(zip(range(0x05, 0x15), "a A i I u U RRi LLi e.c e e ai o.c o o au".split(), strict=True))
_SIGNS = dict(zip(range(0x3E, 0x4D), "A i I u U RRi RRI e.c e e ai o.c o o au".split(), strict=True))
_CONSONANTS = dict(zip(range(0x15, 0x3A), "k kh g gh ~N ch Ch j jh ~n T Th D Dh N t th d dh n n p ph b bh m y r R l L zh v sh Sh s h".split(), strict=True))
_NUKTA = dict(zip(range(0x58, 0x60), "q K G z .D .Dh f Y".split(), strict=True))
_OTHER = {0x01: ".N", 0x02: "M", 0x03: "H", 0x3D: ".a", 0x50: "OM", 0x64: ".", 0x65: ".."}
_VIRAMA, _NUKTA_SIGN = 0x4D, 0x3C
#: Devanagari, Bengali, Gurmukhi, Gujarati, Tamil, Telugu, Kannada, Malayalam.
_BLOCKS = (0x900, 0x980, 0xA00, 0xA80, 0xB80, 0xC00, 0xC80, 0xD00)


def _offset(char: str) -> int | None:
    point = ord(char)
    block = point & ~0x7F
    return point - block if block in _BLOCKS else None


def to_itrans(text: str) -> str:
    """Each consonant has an ``a`` unless a vowel sign or a virama follows; other characters stay."""
    out: list[str] = []
    pending = False
    for char in text:
        at = _offset(char)
        if at is None:
            out.append("a" * pending + char)
            pending = False
        elif at in _CONSONANTS or at in _NUKTA:
            out.append("a" * pending + (_CONSONANTS.get(at) or _NUKTA[at]))
            pending = True
        elif at in _SIGNS and pending:
            out.append(_SIGNS[at])
            pending = False
        elif at == _VIRAMA:
            pending = False
        elif at == _NUKTA_SIGN:
            continue
        else:
            out.append("a" * pending + (_VOWELS.get(at) or _OTHER.get(at) or (str(at - 0x66) if 0x66 <= at <= 0x6F else "")))
            pending = False
    return "".join(out) + "a" * pending
