import random
from dataclasses import replace

import pytest

from weftlink.config import Settings
from weftlink.operators import ml
from weftlink.plans import run
from weftlink.sources.entities import MissingTargetError

WORDS = "alpha bravo delta echo foxtrot golf hotel india kilo lima mango north oscar papa quebec romeo sierra tango union victor".split()


def write(path, rows):
    path.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join("\t".join(r) + "\n" for r in rows))


def test_train_then_infer(spark, tmp_path):
    r = random.Random(1)
    for split in ("train", "test"):
        folder = tmp_path / split
        folder.mkdir()
        s1, s2, s3, truth = [], [], [], []
        for k in range(24):
            name, street, country = " ".join(r.sample(WORDS, 3)), f"{r.randint(1, 99)} {r.choice(WORDS)} st", ("us", "fr")[k % 2]
            s1.append((f"S1-{k}", f"{name} Inc", street, country))
            s2.append((f"S2-{k}", f"{name} inc.", street if k % 3 else "N/A", country.upper()))
            s3.append((f"S3-{k}", " ".join(r.sample(WORDS, 3)), f"{r.randint(1, 99)} {r.choice(WORDS)} rd", country))
            truth.append(f"S1-{k}\tS2-{k}\n")
        for n, rows in enumerate((s1, s2, s3), 1):
            write(folder / f"{split}_s{n}.tsv", rows)
        (folder / "truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join(truth))
    base = f"file://{tmp_path}"
    settings = replace(Settings(), data_dir_train=f"{base}/train", data_dir_test=f"{base}/test", ground_truth_path=f"{base}/train/truth.tsv", processed_data_dir=f"{base}/processed", model_output_path=f"{base}/model", output_dir=f"{base}/out/", cv_folds=2)
    meta = run.train(spark, settings)
    assert meta["feature_names"] == ml.FEATURE_COLS and 0.5 <= meta["threshold"] < 1
    run.infer(spark, settings)
    found = dict(line.split("\t") for line in (tmp_path / "out" / "matching_results.tsv").read_text().splitlines())
    assert sorted(found) == sorted(f"S1-{k}" for k in range(24))
    assert sum(found[f"S1-{k}"] == f"S2-{k}" for k in range(24)) >= 18
    assert (tmp_path / "out" / "candidate_pairs.tsv").is_file() and (tmp_path / "out" / "candidate_pairs_per_cycle.tsv").is_file()
    write(tmp_path / "test" / "test_s1.tsv", [("S1-0", "a b", "1 st", "de")])
    with pytest.raises(MissingTargetError):
        run.infer(spark, settings)
