"""The whole job on temporary trees."""

import os
import re

import pytest
from pyspark.sql import functions as F

from passagemill import schemas, sinks
from passagemill.__main__ import main
from passagemill.plans import job
from passagemill.plans.job import CorpusChangedError, NoDataError, build_datasets, prepare_records, run_job
from passagemill.sinks import in_shuffled_order
from passagemill.sources.files import list_files, read_lines
from passagemill.sources.metadata import scan_sources

PROMPT = "Given the following example text, use dialectal markers to identify the country of origin: "


def corpus(tmp_path, n=200):
    root = tmp_path / "corpora"
    (root / "sub").mkdir(parents=True)
    for name, start in (("a.txt", 0), ("sub/b.TXT", n)):
        lines = []
        for i in range(start, start + n):
            lines += [f"@@{i % 150} text {i} , <b>bold</b> @ mark !", "untagged"]
        (root / name).write_text("\n".join(lines))
    sources = tmp_path / "sources.txt"
    rows = [f"{i} 10 FIC {1900 + i} SRC{i % 7} Title{i} some info {i}" for i in range(100)]
    rows += [rows[5]] * 3 + ["5 11 FIC 1888 OTHER T x y", "broken line"]
    sources.write_text("\n".join(rows) + "\n")
    return str(root), str(sources)


def expected(tmp_path):
    """(human, gpt, source) of every merged row."""
    root, sources = tmp_path / "corpora", tmp_path / "sources.txt"
    table = [line.split(maxsplit=6) for line in sources.read_text().splitlines()]
    table = [p for p in table if len(p) >= 7]
    out = []
    for name in ("a.txt", "sub/b.TXT"):
        for line in (root / name).read_text().splitlines():
            if not line.startswith("@@"):
                continue
            key, text = line[2:].split(" ", 1)
            text = re.sub(r"</?b>", "", text).replace("@ ", "").replace(" ,", ",").replace(" !", "!")
            for p in table:
                if p[0] == key:
                    out.append((PROMPT + text, f"The sample you provided appears to be from {p[3]}.", p[4]))
    return sorted(out)


def flat(df):
    return [(r.conversations[0].value, r.conversations[1].value, r.source) for r in df.collect()]


def test_lazy_datasets(spark, tmp_path):
    root, sources = corpus(tmp_path)
    data = build_datasets(spark, root, sources)
    train, rest = flat(data.train), flat(data.eval)
    want = expected(tmp_path)
    assert sorted(train + rest) == want
    assert len(train) == int(len(want) * 0.8)
    assert data.train.schema.simpleString() == schemas.RECORD.simpleString()
    audit = {r.metric: r.value for r in data.audit.collect()}
    assert audit == {
        "files_found": 2, "lines_collected": 400, "sources_loaded": 104, "sources_rejected": 1,
        "rows_before_join": 400, "rows_after_join": len(want),
        "train_rows": len(train), "eval_rows": len(rest),
    }


def test_job_writes_both_sides_in_shuffled_order(spark, tmp_path):
    root, sources = corpus(tmp_path)
    base = str(tmp_path / "out")
    result = run_job(spark, root, sources, base, target_file_bytes=4000)
    train, rest = (spark.read.parquet(f"{base}_{side}.parquet") for side in ("train", "eval"))
    assert result.paths == [f"{base}_train.parquet", f"{base}_eval.parquet"]
    lazy = build_datasets(spark, root, sources)
    assert sorted(flat(train)) == sorted(flat(lazy.train))
    assert sorted(flat(rest)) == sorted(flat(lazy.eval))
    assert len(train.inputFiles()) > 1
    audit = {r.metric: r.value for r in result.audit.collect()}
    assert audit["train_rows"] + audit["eval_rows"] == audit["rows_after_join"] == len(expected(tmp_path))
    assert audit["files_processed"] == 2 and audit["files_skipped"] == 0
    shown = result.preview.collect()
    assert len(shown) == 5 and {r.conversations for r in shown} == {"[2 messages]"}
    # File order and row order follow the key of the stored records.
    records = spark.read.parquet(f"{result.staging}/records")
    assert {r[0] for r in records.select("slice").distinct().collect()} == {0, 1, 2}
    by_key = [tuple(r) for r in records.orderBy("shuffle_key").select("conversations", "source").collect()]
    files = sorted(train.inputFiles(), key=lambda p: p.rsplit("/", 1)[1])
    in_order = [
        tuple(r) for f in files for r in spark.read.parquet(f).select("conversations", "source").collect()
    ]
    assert in_order == by_key[: len(in_order)]


def test_files_are_sized_by_rows_not_by_their_stored_bytes(spark, tmp_path):
    """Lines that Parquet packs to next to nothing are still read and sorted whole by the tasks that write them."""
    root = tmp_path / "corpora"
    root.mkdir()
    (root / "a.txt").write_text("\n".join(f"@@{i % 10} " + "the same words again " * 250 for i in range(400)))
    sources = tmp_path / "sources.txt"
    sources.write_text("\n".join(f"{i} 10 FIC 1990 SRC Title some info" for i in range(10)) + "\n")
    target = 200_000
    run_job(spark, str(root), str(sources), str(tmp_path / "out"), target_file_bytes=target)
    train = spark.read.parquet(str(tmp_path / "out_train.parquet"))
    texts = F.octet_length(F.col("conversations")[0]["value"]) + F.octet_length(F.col("conversations")[1]["value"])
    sizes = [r[1] for r in train.groupBy(F.input_file_name()).agg(F.sum(texts)).collect()]
    assert train.count() == 320
    assert max(sizes) < 1.5 * target


def test_strategies_agree(spark, tmp_path, monkeypatch):
    """Stored tables too large to broadcast: lines are ranked per block, the join is salted."""
    root, sources = corpus(tmp_path)
    small = run_job(spark, root, sources, str(tmp_path / "small"))
    monkeypatch.setattr("passagemill.plans.job.fits_broadcast", lambda df: False)
    large = run_job(spark, root, sources, str(tmp_path / "large"))
    for a, b in zip(small.paths, large.paths):
        a, b = spark.read.parquet(a), spark.read.parquet(b)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.count() == b.count()


def test_one_row_goes_to_eval_and_no_train_file_is_written(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.txt").write_text("@@1 x\n")
    (tmp_path / "s.txt").write_text("1 2 3 4 5 6 7\n")
    result = run_job(spark, str(tmp_path / "c"), str(tmp_path / "s.txt"), str(tmp_path / "o"))
    assert result.paths == [str(tmp_path / "o_eval.parquet")] and result.preview is None


@pytest.mark.parametrize(
    "text, source, message",
    [
        ("@@1 x", "too short", "source line"),
        ("none", "1 2 3 4 5 6 7", "tagged line was found"),
        ("@@1", "1 2 3 4 5 6 7", "could be parsed"),
        ("@@2 x", "1 2 3 4 5 6 7", "has a source"),
    ],
)
def test_empty_stages_stop_the_job(spark, tmp_path, text, source, message):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.txt").write_text(text)
    (tmp_path / "s.txt").write_text(source)
    with pytest.raises(NoDataError, match=message):
        run_job(spark, str(tmp_path / "c"), str(tmp_path / "s.txt"), str(tmp_path / "o"))
    assert not (tmp_path / "o_train.parquet").exists()


def test_each_side_reads_its_slices_and_shuffles_once(spark, tmp_path):
    root, sources = corpus(tmp_path)
    prepared = prepare_records(
        read_lines(spark, root), list_files(spark, root), scan_sources(spark, sources), str(tmp_path / "staging")
    )
    plan = in_shuffled_order(prepared.side("train").drop("slice"), 4)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(slice" in plan
    assert "LessThan(shuffle_key" in plan
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("change", ["removed", "shortened", "lengthened", "added"])
def test_a_corpus_that_changes_stops_the_job(spark, tmp_path, monkeypatch, change):
    root, sources = corpus(tmp_path, n=5)
    target = tmp_path / "corpora" / ("c.txt" if change == "added" else "a.txt")

    def prepared_then_changed(*args, real=job._records):
        result = real(*args)
        text = "" if change == "added" else target.read_text()
        target.unlink() if change == "removed" else target.write_text(text[:40] if change == "shortened" else text + "\n@@1 more")
        return result

    monkeypatch.setattr(job, "_records", prepared_then_changed)
    with pytest.raises(CorpusChangedError, match=target.name):
        run_job(spark, root, sources, str(tmp_path / "o"))
    assert not (tmp_path / "o_train.parquet").exists()


def test_a_file_that_vanishes_is_an_error(spark, tmp_path):
    root, _ = corpus(tmp_path, n=5)
    spark.conf.set("spark.sql.files.ignoreMissingFiles", "true")
    lines = read_lines(spark, root)
    (tmp_path / "corpora" / "a.txt").unlink()
    try:
        with pytest.raises(Exception, match="a.txt"):
            lines.collect()
    finally:
        spark.conf.unset("spark.sql.files.ignoreMissingFiles")


def test_outputs_agree_with_the_last_run(spark, tmp_path):
    root, sources = corpus(tmp_path, n=20)
    base = str(tmp_path / "o")
    first = run_job(spark, root, sources, base, keep_staging=False)
    assert len(first.paths) == 2 and not os.path.exists(first.staging)
    with pytest.raises(FileExistsError):
        run_job(spark, root, str(tmp_path / "none.txt"), base)  # before anything is read
    (tmp_path / "corpora" / "a.txt").write_text("@@1 x")
    (tmp_path / "corpora" / "sub" / "b.TXT").unlink()
    second = run_job(spark, root, sources, base, write_mode="overwrite")
    assert second.paths == [f"{base}_eval.parquet"] and not os.path.exists(f"{base}_train.parquet")
    schema = spark.read.parquet(f"{base}_eval.parquet").schema.simpleString()
    assert schema == schemas.RECORD.simpleString()


def test_colons_in_sources_do_not_make_rows_alike(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.txt").write_text("@@1 x")
    (tmp_path / "s.txt").write_text("1 2 3 4 5 a b:c\n1 2 3 4 5 a:b c\n")
    result = run_job(spark, str(tmp_path / "c"), str(tmp_path / "s.txt"), str(tmp_path / "o"), ratio=0.5)
    assert [spark.read.parquet(p).count() for p in result.paths] == [1, 1]


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    root, sources = corpus(tmp_path)
    monkeypatch.setattr("sys.argv", ["passagemill", "--corpus", root, "--sources", sources, "--output", str(tmp_path / "o")])
    main()
    assert "rows_after_join" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "o_train.parquet")).count() > 0


def test_one_scan_per_side(spark, tmp_path):
    root, sources = corpus(tmp_path)
    data = build_datasets(spark, root, sources)
    for side in (data.train, data.eval):
        plan = side._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan text") == 1
    counts = {r.metric: r.value for r in data.audit.collect()}
    n = len(expected(tmp_path))
    assert counts["rows_after_join"] == n and counts["train_rows"] == int(n * 0.8) and counts["eval_rows"] == n - int(n * 0.8)
    assert (counts["files_found"], counts["sources_rejected"], counts["lines_collected"]) == (2, 1, 400)


def test_both_sides_or_none(spark, tmp_path, monkeypatch):
    root, sources = corpus(tmp_path)
    base = f"{tmp_path}/out"
    result = run_job(spark, root, sources, base)
    before = [sorted(flat(spark.read.parquet(path))) for path in result.paths]
    moves = []

    def fail_at_second(spark_, uri, real=sinks._location):
        moves.append(uri)
        if uri.endswith("/eval"):
            raise OSError("no more")
        return real(spark_, uri)

    monkeypatch.setattr(sinks, "_location", fail_at_second)
    with pytest.raises(OSError, match="no more"):
        run_job(spark, root, sources, base, seed=7, write_mode="overwrite", keep_staging=False)
    monkeypatch.undo()
    assert [sorted(flat(spark.read.parquet(path))) for path in result.paths] == before
    assert not [n for n in os.listdir(tmp_path) if "unfinished" in n]
    again = run_job(spark, root, sources, base, seed=7, write_mode="overwrite")
    assert again.paths == result.paths and [sorted(flat(spark.read.parquet(path))) for path in again.paths] != before


def test_staging_goes_when_the_job_fails(spark, tmp_path, monkeypatch):
    root, _ = corpus(tmp_path)
    (tmp_path / "none.txt").write_text("no source\n")
    
    for keep in (True, False):
        folder = tmp_path / f"staging-{keep}"
        monkeypatch.setattr(job, "staging_folder", lambda *_, folder=folder: str(folder))
        with pytest.raises(NoDataError):
            run_job(spark, root, str(tmp_path / "none.txt"), f"{tmp_path}/out", keep_staging=keep)
        assert folder.exists() == keep


def test_bad_files_are_skipped_and_counted(spark, tmp_path):
    root, sources = corpus(tmp_path)
    bad = tmp_path / "corpora" / "bad.txt"
    bad.write_text("@@1 lost line\n" * 200)
    (bad.parent / ".bad.txt.crc").write_bytes(b"crc\0" + (512).to_bytes(4, "big") + b"\0\0\0\1" * 6)
    with pytest.raises(Exception, match="(?i)checksum"):
        run_job(spark, root, sources, f"{tmp_path}/strict")
    result = run_job(spark, root, sources, f"{tmp_path}/out", skip_bad_files=True, keep_staging=False)
    assert [(r.uri.rpartition("/")[2], r.outcome) for r in result.skipped.collect()] == [("bad.txt", "unreadable")]
    counts = {r.metric: r.value for r in result.audit.collect()}
    assert (counts["files_found"], counts["files_skipped"], counts["files_unreadable"]) == (3, 1, 1)
    assert sorted(x for path in result.paths for x in flat(spark.read.parquet(path))) == expected(tmp_path)
