import json

import pytest
from pyspark.sql import functions as F

from weftlink.operators import outputs, state
from weftlink.sources import entities as io

ROWS = [("S1-001", "C-02", 1, 1, False), ("S1-001", "C-01", 1, 2, True), ("S1-001", "C-03", 2, 3, True), ("S1-001", "C-01", 2, 4, False), ("S1-003", "B", 1, 5, True), ("S1-003", "A", 1, 6, True), ("S1-003", "A", 10, 7, True), ("S1-003", "Z", 10, 8, False), ("S1-003", "Y", 2, 9, False)]


@pytest.fixture(scope="module")
def tables(spark):
    ids = spark.createDataFrame([("S1-001",), ("S1-002",), ("S1-003",)], "entity_id string")
    return ids, spark.createDataFrame(ROWS, "entity_id string, cand_id string, cycle int, seq long, accepted boolean")


def test_sets_and_cycles(tables):
    got = {r.entity_id: r for r in state.nested(*tables).collect()}
    one = got["S1-001"]
    assert (one.accepted, one.rejected, one.per_cycle) == (["C-01", "C-03"], ["C-02"], {"1": ["C-02", "C-01"], "2": ["C-03"]})
    assert (got["S1-002"].accepted, got["S1-002"].rejected, got["S1-002"].per_cycle) == ([], [], {})


def test_state_round_trip(spark, tables, tmp_path):
    path = f"file://{tmp_path}/state"
    nested = state.nested(*tables)
    for _ in range(2):  # a batch that is written again replaces itself
        state.append_state(nested.where("entity_id = 'S1-001'"), path, 0)
    state.append_state(nested.where("entity_id = 'S1-003'"), path, 1)
    (tmp_path / "state" / "batch=2").mkdir()
    (tmp_path / "state" / "batch=2" / "x.txt").write_text('\nnot json\n{"S1-009": {"accepted": ["a"], "rejected": [], "per_cycle": {"1": ["a"]}}}\n')
    assert sorted(r.entity_id for r in state.completed(spark, path).collect()) == ["S1-001", "S1-003", "S1-009"]
    assert [r.entity_id for r in state.pending(tables[0], state.completed(spark, path)).collect()] == ["S1-002"]
    back = state.from_nested(state.read_state(spark, path)).where("entity_id <> 'S1-009'").select("entity_id", "cand_id", "cycle", "accepted").collect()
    first = state.first_decisions(tables[1]).select("entity_id", "cand_id", "cycle", "accepted").collect()
    assert sorted(back) == sorted(first)


def test_outputs(spark, tables, tmp_path):
    outputs.write_all(*tables, f"file://{tmp_path}")
    read = lambda name: "".join(p.read_text() for p in sorted((tmp_path / name).glob("part-*"))).splitlines()
    assert read("matching_results.tsv") == ["S1-001\tC-01,C-03", "S1-002\t", "S1-003\tA,B"]
    assert read("candidate_pairs.tsv") == ["S1-001\tC-01,C-02,C-03", "S1-002\t", "S1-003\tA,B,Y,Z"]
    assert read("candidate_pairs_per_cycle.tsv") == ["S1-001\t1\tC-01,C-02", "S1-001\t2\tC-03", "S1-002\t\t", "S1-003\t1\tA,B", "S1-003\t2\tY", "S1-003\t10\tZ"]
    with pytest.raises(state.FileWriteError):
        outputs.write_tsv(tables[0], "nosuchscheme://x/y", [F.col("entity_id")])


def test_seen_state(tmp_path):
    run = str(tmp_path / "run")
    s = state.SeenState(run, batch_size=2)
    s.init_entity("S1-001")
    with pytest.raises(state.AlreadyActiveError):
        s.init_entity("S1-001")
    s.update_seen("S1-001", "C-02", 1, True)
    s.update_seen("S1-001", "C-01", 1, False)
    s.update_seen("S1-001", "C-01", 2, True)
    assert s.has_been_seen("S1-001", "C-01") and not s.has_been_seen("S1-009", "C-01") and "S1-009" not in s.active
    s.finalize_entity("S1-001")
    assert not s.path.exists()
    s.finalize_entity("S1-002")
    lines = [json.loads(x) for x in s.path.read_text().splitlines()]
    assert lines[0] == {"S1-001": {"accepted": ["C-02"], "rejected": ["C-01"], "per_cycle": {"1": ["C-02", "C-01"]}}}
    for call in (lambda: s.init_entity("S1-001"), lambda: s.update_seen("S1-001", "x", 1, True), lambda: s.finalize_entity("S1-002")):
        with pytest.raises(state.AlreadyFinalizedError):
            call()
    s.path.write_text(s.path.read_text() + "\nbroken\n")
    again = state.SeenState(run)
    assert again.done == {"S1-001", "S1-002"}
    again.write_all_outputs(str(tmp_path / "out"))
    assert (tmp_path / "out" / "matching_results.tsv").read_text() == "S1-001\tC-02\nS1-002\t\n"
    assert (tmp_path / "out" / "candidate_pairs_per_cycle.tsv").read_text() == "S1-001\t1\tC-01,C-02\nS1-002\t\t\n"
    state.SeenState(str(tmp_path / "none")).write_all_outputs(str(tmp_path / "empty"))
    assert (tmp_path / "empty" / "candidate_pairs.tsv").read_text() == ""


def test_seen_state_types(tmp_path):
    s = state.SeenState(str(tmp_path))
    for bad in (lambda: state.SeenState(3), lambda: s.init_entity(3), lambda: s.update_seen("a", 3, 1, True), lambda: s.update_seen("a", "b", "1", True), lambda: s.update_seen("a", "b", 1, "yes"), lambda: s.has_been_seen("a", None), lambda: s.finalize_entity(None)):
        with pytest.raises(TypeError):
            bad()
    s.update_seen("a", "b", True, True)


def test_files(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tA "B" Inc\tN/A\tus\nS1-2\t\t1 Rd\tfr\n')
    raw = io.read_entities(spark, f"file://{tmp_path}/a.tsv").orderBy("entity_id")
    assert [tuple(r) for r in raw.collect()] == [("S1-1", 'A "B" Inc', "", "us"), ("S1-2", "", "1 Rd", "fr")]
    (tmp_path / "b.csv").write_text("x,y\n1,2\n")
    for bad in ("b.csv", "none.tsv"):
        with pytest.raises(io.InvalidFileFormatError):
            io.read_entities(spark, f"file://{tmp_path}/{bad}")
    (tmp_path / "t.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1, S3-2\nS1-2\t\n")
    assert sorted(tuple(r) for r in io.read_truth(spark, f"file://{tmp_path}/t.tsv").collect()) == [("S1-1", "S2-1"), ("S1-1", "S3-2")]
    a = io.clean(raw, "S1")
    b = io.clean(raw.withColumn("country", F.lit("de")), "S2")
    io.write_partitions(a, b, f"file://{tmp_path}/p")
    back = io.read_partitions(spark, f"file://{tmp_path}/p", "Query")
    assert back.count() == 2 and [r.country for r in io.discover_countries(back).collect()] == ["fr", "us"]
    assert io.missing_targets(back, io.read_partitions(spark, f"file://{tmp_path}/p", "Target")).count() == 2
    with pytest.raises(io.PartitioningError):
        io.write_partitions(a.withColumn("country", F.lit(" ")), b, f"file://{tmp_path}/q")


def test_stream(spark, tables, tmp_path):
    from weftlink.streaming.decisions import process_entities

    ids, decisions = tables
    source, target = f"file://{tmp_path}/in", f"file://{tmp_path}/state"
    for batch in ("entity_id = 'S1-001'", "entity_id <> 'S1-002'", "entity_id = 'S1-002'"):
        ids.where(batch).write.mode("append").parquet(source)
        run = process_entities(spark, source, "entity_id string", lambda new: decisions.join(new, "entity_id"), target, f"file://{tmp_path}/checkpoint")
        assert run.awaitTermination(120)
    read = lambda: sorted((r.entity_id, r.accepted, r.rejected, repr(r.per_cycle)) for r in state.read_state(spark, target).collect())
    rows = read()
    assert [r[0] for r in rows] == ["S1-001", "S1-002", "S1-003"]
    # A batch that was written but not committed is replayed, and finds the same state.
    commits = tmp_path / "checkpoint" / "commits"
    for name in ("2", ".2.crc"):
        if (commits / name).exists():
            (commits / name).unlink()
    assert run_again(spark, source, lambda new: decisions.join(new, "entity_id"), target, tmp_path) and read() == rows
    for p in (tmp_path / "state" / "batch=2").iterdir():  # or was only half written
        p.unlink()
    (commits / "2").unlink()
    (commits / ".2.crc").unlink(missing_ok=True)
    assert run_again(spark, source, lambda new: decisions.join(new, "entity_id"), target, tmp_path) and read() == rows


def run_again(spark, source, decide, target, tmp_path):
    from weftlink.streaming.decisions import process_entities

    return process_entities(spark, source, "entity_id string", decide, target, f"file://{tmp_path}/checkpoint").awaitTermination(120)


def test_stream_over_an_older_state(spark, tables, tmp_path):
    """Entities of a state without ids beside it are left out, whoever wrote it."""
    ids, decisions = tables
    (tmp_path / "state").mkdir()
    (tmp_path / "state" / "x.txt").write_text('{"S1-003": {"accepted": ["a"], "rejected": [], "per_cycle": {"1": ["a"]}}}\nbroken\n')
    ids.write.parquet(f"file://{tmp_path}/in")
    assert run_again(spark, f"file://{tmp_path}/in", lambda new: decisions.join(new, "entity_id"), f"file://{tmp_path}/state", tmp_path)
    rows = {r.entity_id: r.accepted for r in state.read_state(spark, f"file://{tmp_path}/state").collect()}
    assert rows == {"S1-001": ["C-01", "C-03"], "S1-002": [], "S1-003": ["a"]}


def test_files_of_their_names(spark, tables, tmp_path):
    outputs.write_all(*tables, f"file://{tmp_path}", header=True, files=True)
    assert (tmp_path / "matching_results.tsv").read_text() == "entity_id\tids\nS1-001\tC-01,C-03\nS1-002\t\nS1-003\tA,B\n"
    assert (tmp_path / "candidate_pairs_per_cycle.tsv").read_text().splitlines()[-1] == "S1-003\t10\tZ"


def test_checks(spark):
    a = spark.createDataFrame([("fr",), ("us",)], "country string")
    io.check_targets(a, a)
    io.check_rows(a, a, "x")
    with pytest.raises(FileNotFoundError):
        io.check_targets(a, a.where("country = 'us'"))
    with pytest.raises(io.RowCountError):
        io.check_rows(a, a.limit(1), "x")
