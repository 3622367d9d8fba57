"""Token ids of whole texts with the tokenizers library, each distinct word encoded once.

Both vocabularies cut a text into words before they merge, and no merge crosses a word. So the
ids of a text are those of its words in order. A text of Latin letters is cut into words by the
tokenizer's own rule, written for these letters alone; any other one into chunks at white space,
where the rule cuts, too. Words and chunks are remembered in bounded tables that a worker keeps
until its task, or its user, empties them; plain words go straight to the library's merges, others through all of it, and a text
that cannot be cut safely goes there whole.
"""

from __future__ import annotations

import json
import os
import re
import struct

import numpy as np

#: Chunks remembered by a worker, about 200 bytes each; then the older half makes room.
REMEMBERED = 400_000
#: Characters of the longest chunk that is remembered.
LONGEST = 48
#: Characters handled at a time: bounds the chunk lists of very long texts.
SPAN = 1 << 20

#: White space other than the space and the newline, and controls some libraries take for it.
_ODD = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\0]")
#: Letters below this one lower and normalise one by one, in every version of Unicode.
_FIRST_ODD_LETTER, _DOTTED_I = "\u0250", "\u0130"
_MARKS = frozenset(".,;:!?")

# Letters, numbers and white space up to U+017F. Lower-casing and composition keep each of them one letter there, but for U+0130.
_LETTER, _NUMBER, _SPACE = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
#: Beyond them only dashes and quotes.
_NOT_LATIN = re.compile("[^\0-\u012f\u0131-\u017f\u2010-\u2027]")
_SUFFIXES = "'s|'t|'re|'ve|'m|'ll|'d"
#: The rules of tokenizers that drop white space, and that keep a space with the word after it.
_BARE_WORDS = re.compile(f"[{_LETTER}]+|{_SUFFIXES}|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
_SPACED_WORDS = re.compile(f" ?[{_LETTER}]+|{_SUFFIXES}| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_BARE_RULE = _SUFFIXES + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_BARE_FORM = ["NFC", "Replace", "Lowercase"]


def _byte_letters() -> dict[int, str]:
    """What stands for each byte in a byte-level vocabulary: itself if it is printable, else a letter from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


_LETTERS = _byte_letters()


class _Table(dict):
    """chunk -> ids as little-endian unsigned 32-bit integers, encoded when first asked for."""

    def __init__(self, make):
        self.older: dict[str, bytes] = {}
        self.make = make

    def __missing__(self, chunk: str) -> bytes:
        known = self.older.get(chunk)
        if known is None:
            known = self.make(chunk)
        if len(chunk) <= LONGEST:
            self[chunk] = known
        return known

    def aged(self) -> _Table:
        """An empty table with this one behind it."""
        new = _Table(self.make)
        self.older, new.older = {}, self
        return new


class Encoder:
    """ids of texts by one tokenizer file, without special tokens added."""

    _made: dict[tuple[str, int], Encoder] = {}

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.remembered = remembered
        #: True if spaces belong to the words after them (byte-level); else white space is dropped.
        self.spaced = self.tokenizer.normalizer is None
        self.marks = {m: self.whole(m) for m in _MARKS}
        self.rule = self._rule()
        #: Contents of added tokens, which are cut out before any rule.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def _rule(self) -> re.Pattern | None:
        """Cuts a Latin text into words as the tokenizer does; None if its rule is another one."""
        split, form = (json.loads(x.__getstate__()) if x is not None else {} for x in (self.tokenizer.pre_tokenizer, self.tokenizer.normalizer))
        if not form and split.get("type") == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]:
            return _SPACED_WORDS
        steps = split.get("pretokenizers", [{}])
        bare = len(steps) == 2 and steps[0].get("pattern") == {"Regex": _BARE_RULE} and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
        if bare and not steps[1].get("use_regex", True) and [x["type"] for x in form.get("normalizers", [])] == _BARE_FORM:
            return _BARE_WORDS
        return None

    @classmethod
    def of(cls, path: str, remembered: int = REMEMBERED) -> Encoder:
        """One encoder for a worker process, kept over its tasks."""
        if (path, remembered) not in cls._made:
            cls._made[path, remembered] = cls(path, remembered)
        return cls._made[path, remembered]

    def forget(self) -> None:
        """Empties the tables."""
        self.table, self.words = _Table(self._encode_chunk), _Table(self._encode_word)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _chunks(self, text: str, starts: bool) -> list[str] | None:
        """Keys of the table; None if the text must go whole. starts: no space went before it."""
        if not self.spaced:
            return [x for x in text.replace("\n", " ").replace("\t", " ").split(" ") if x]
        chunks = text.replace("\n", " \n").split(" ")
        if "" in chunks[not starts :] or "\n" in chunks or _ODD.search(text):
            return None  # white space meets white space
        if not starts:
            return chunks[1:]
        if not chunks[0].startswith("\n"):
            chunks[0] = "\0" + chunks[0]
        return chunks

    def _text(self, key: str) -> str:
        """What a key stands for: a space goes before it, unless it starts the text or a line."""
        if not self.spaced or key[0] == "\n":
            return key
        return key[1:] if key[0] == "\0" else " " + key

    def _encode_chunk(self, key: str) -> bytes:
        """ids of a chunk. A word of plain letters is one word for the tokenizer, too, and a mark after it the next."""
        body = key
        if self.spaced and key[0] in "\0\n":
            body = key[1:]
        if body and body[-1] in self.marks and body[:-1].isalpha():
            return self.table[key[:-1]] + self.marks[body[-1]]
        if body.isalpha() and (body.isascii() or max(body) < _FIRST_ODD_LETTER and _DOTTED_I not in body):
            if self.spaced and key[0] == "\n":
                return self.table["\n"] + self.table["\0" + body]
            return self._plain(body if self.spaced else body.lower(), self.spaced and body is key)
        return self.whole(self._text(key))

    def _plain(self, body: str, after_space: bool) -> bytes:
        """ids of a word of plain letters."""
        if not body.isascii():
            body = body.encode().decode("latin-1").translate(_LETTERS)
        ids = [t.id for t in self.model.tokenize(_LETTERS[32] + body if after_space else body)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _encode_word(self, word: str) -> bytes:
        """ids of a word as the rule cuts it."""
        body = word[1:] if word[0] == " " else word
        return self._plain(body, body is not word) if body.isalpha() else self.whole(word)

    def _latin(self, text: str) -> bool:
        """If the rule for Latin letters cuts the text."""
        if self.rule is None or any(t in text for t in self.added):
            return False
        if text.isascii():
            return True
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return not _NOT_LATIN.search(text)
        return True

    def _spans(self, text: str) -> list[str]:
        """The text in parts of about SPAN characters, cut before a single space between words."""
        parts, at = [], 0
        while len(text) - at > 2 * SPAN:
            cut = text.find(" ", at + SPAN)
            while 0 < cut < len(text) - 1 and (text[cut - 1].isspace() or text[cut + 1].isspace()):
                cut = text.find(" ", cut + 1)
            if not 0 < cut < len(text) - 1:
                break
            parts.append(text[at:cut])
            at = cut
        return [*parts, text[at:]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for text in texts:
            own: list[bytes] = []
            for k, part in enumerate(self._spans(text) if text else ()):
                if self._latin(part):
                    words = self.rule.findall(part if self.spaced else part.lower())
                    own.append(b"".join(map(self.words.__getitem__, words)))
                else:
                    chunks = self._chunks(part, k == 0)
                    own.append(self.whole(part) if chunks is None else b"".join(map(self.table.__getitem__, chunks)))
                if len(self.table) + len(self.words) > self.remembered // 2:
                    self.table, self.words = self.table.aged(), self.words.aged()
            out.append(own[0] if len(own) == 1 else b"".join(own))
        return out
