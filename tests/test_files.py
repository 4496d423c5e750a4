"""Scan of text-file trees: encodings, line numbers, file order, bad input."""

import zlib

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from passagemill.operators.ordering import number_rows
from passagemill.sources.files import (
    file_blocks, file_outcomes, first_pass, list_files, number_in_place, number_lines, place_blocks, read_lines, scan_corpus,
)
from passagemill.sources.metadata import scan_sources
from passagemill.sources.side_table import write_side_table
from passagemill.storage import store_in

TREE = {
    "A.TXT": b"@@1 one\r\nskip\r@@2 two\n\n  @@3\tthree x\n@@4\n@@ five",
    "lat.txt": b"@@20 ascii\n@@21 caf\xe9 \x93q\x94\n\xa0@@22 nbsp\n",
    "mix.txt": b"@@30 caf\xc3\xa9\n@@31 bad\xe9\n\xc2\xa0@@32 not tagged in Latin-1\n",
    "sur.txt": b"@@50 \xed\xa0\x80\n",
    "bom.txt": b"\xef\xbb\xbf@@40 bom\n@@41 ok\n\xc2\xa0@@42 tagged\n",
    "ls.txt": "@@60 a b\x0bc\x85d\n".encode(),
    "b dir/a+b 100%é.txt": b"@@70 path\n",
    "b/z.txt": b"@@80 z\n",
    "b/sub/y.txt": b"@@81 y\n",
    "empty.txt": b"",
    "n.md": b"@@90 no\n",
    "_u.txt": b"@@91 no\n",
    ".h.txt": b"@@92 no\n",
    ".hid/i.txt": b"@@93 no\n",
}


def write_tree(root, tree):
    for name, data in tree.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    return str(root)


def test_tagged_lines_of_a_tree(spark, tmp_path):
    root = write_tree(tmp_path, TREE)
    rows = scan_corpus(spark, root).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r.sequence):
        got.setdefault(r.file.removeprefix(root + "/"), []).append((r.line_num, r.line))
    assert got == {
        "A.TXT": [(0, "@@1 one"), (2, "@@2 two"), (4, "@@3\tthree x"), (5, "@@4"), (6, "@@ five")],
        "lat.txt": [(0, "@@20 ascii"), (1, "@@21 café \x93q\x94"), (2, "@@22 nbsp")],
        "mix.txt": [(0, "@@30 cafÃ©"), (1, "@@31 badé")],
        "sur.txt": [(0, "@@50 í\xa0\x80")],
        "bom.txt": [(0, "@@40 bom"), (1, "@@41 ok"), (2, "@@42 tagged")],
        "ls.txt": [(0, "@@60 a b\x0bc\x85d")],
        "b dir/a+b 100%é.txt": [(0, "@@70 path")],
        "b/z.txt": [(0, "@@80 z")],
        "b/sub/y.txt": [(0, "@@81 y")],
    }
    for r in rows:
        n = [line for line in got[r.file.removeprefix(root + "/")]].index((r.line_num, r.line)) + 1
        assert r.sequence == r.file_order * 2_000_000 + n


def test_file_order_is_top_down(spark, tmp_path):
    root = write_tree(tmp_path, TREE)
    names = [r.file.removeprefix(root + "/") for r in list_files(spark, root).orderBy("file_order").collect()]
    assert names == [
        "A.TXT", "bom.txt", "lat.txt", "ls.txt", "mix.txt", "sur.txt",
        "b/z.txt", "b/sub/y.txt", "b dir/a+b 100%é.txt",
    ]


@pytest.mark.parametrize("map_side", [False, True])
def test_numbers_do_not_depend_on_splits(spark, tmp_path, map_side):
    expected = []
    for f in range(3):
        lines, n = [], 0
        for i in range(700):
            tagged = (i + f) % 3 != 0
            lines.append((f"@@{f}_{i} text number {i}" if tagged else f"noise {i}") + ("é" if f else ""))
            if tagged:
                n += 1
                expected.append((lines[-1], f, i, f * 2_000_000 + n))
        (tmp_path / f"f{f}.txt").write_bytes("\n".join(lines).encode("latin-1" if f == 2 else "utf-8"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = read_lines(spark, str(tmp_path))
        blocks = place_blocks(file_blocks(lines), list_files(spark, str(tmp_path)))
        assert blocks.count() > 15
        numbered = number_lines(lines, blocks, map_side=map_side)
        rows = numbered.select("line", "file_order", "line_num", "sequence").collect()
        assert sorted(map(tuple, rows)) == sorted(expected)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_map_side_numbering_shuffles_no_text(spark, tmp_path):
    root = write_tree(tmp_path, TREE)
    lines = read_lines(spark, root)
    blocks = place_blocks(file_blocks(lines), list_files(spark, root))
    blocks = spark.createDataFrame(blocks.collect(), blocks.schema)
    plan = number_lines(lines, blocks, map_side=True)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_changed_blocks_stop_the_job(spark, tmp_path):
    root = write_tree(tmp_path, TREE)
    lines = read_lines(spark, root)
    blocks = place_blocks(file_blocks(lines), list_files(spark, root)).where(~F.endswith("uri", F.lit("lat.txt")))
    with pytest.raises(Exception, match="file blocks changed"):
        number_lines(lines, blocks).collect()


def test_missing_corpus_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        scan_corpus(spark, str(tmp_path / "none")).collect()


def test_tree_without_text_files_has_no_lines(spark, tmp_path):
    (tmp_path / "n.md").write_text("@@1 x")
    assert scan_corpus(spark, str(tmp_path)).count() == 0


def test_sources_file(spark, tmp_path):
    path = tmp_path / "sources.txt"
    path.write_bytes(b"1  100 FIC 1990 COCA Title pub info  here\n1\t2 3 4 5 6 7\n\n1 100 FIC 1990 SRC Title\n")
    assert [tuple(r) for r in scan_sources(spark, str(path)).collect()] == [
        ("1", "100", "FIC", "1990", "COCA", "Title", "pub info  here"),
        ("1", "2", "3", "4", "5", "6", "7"),
    ]
    path.write_bytes("1 2 3 4 5 6 café ü\n".encode("latin-1"))
    assert scan_sources(spark, str(path)).first().pubInfo == "café ü"
    missing = str(tmp_path / "none.txt")
    assert scan_sources(spark, missing, missing_ok=True).count() == 0
    with pytest.raises(AnalysisException):
        scan_sources(spark, missing)


def test_numbers_from_a_side_table_without_any_exchange(spark, tmp_path):
    root = write_tree(tmp_path / "tree", TREE)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60")
    try:
        lines, _, blocks, _, _ = first_pass(spark, root, store_in(str(tmp_path / "store")))
        numbered = number_in_place(lines, blocks, str(tmp_path / "store"), limit=0)
        plan = numbered._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
        want = number_in_place(lines, blocks, str(tmp_path / "store"))
        assert sorted(map(tuple, numbered.collect())) == sorted(map(tuple, want.collect()))
        path = str(tmp_path / "less")
        write_side_table(blocks.where(~F.endswith("uri", F.lit("lat.txt"))), ["uri", "task", "block_start", "block_length"], path)
        with pytest.raises(Exception, match="file blocks changed"):
            number_lines(lines, blocks, side_table=path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def break_file(path, at):
    """A checksum that does not fit the bytes from ``at`` on: reading stops there with an error."""
    data = path.read_bytes()
    sums = b"".join(zlib.crc32(data[i : i + 512]).to_bytes(4, "big") for i in range(0, at, 512))
    sums += b"\0\0\0\1" * (-(-len(data) // 512) - at // 512)
    (path.parent / f".{path.name}.crc").write_bytes(b"crc\0" + (512).to_bytes(4, "big") + sums)


def test_bad_files_are_left_out_whole_and_listed(spark, tmp_path):
    root = write_tree(tmp_path, TREE | {"cut.txt": b"@@1 cut line\n" * 40_000, "none.txt": b"@@2 no\n" * 50, "whole.txt": b"@@3 yes\n" * 400})
    break_file(tmp_path / "cut.txt", 409_600)
    break_file(tmp_path / "none.txt", 0)
    with pytest.raises(Exception):
        scan_corpus(spark, root).collect()
    found = {r.uri.rpartition("/")[2]: r.outcome for r in file_outcomes(spark, root).collect()}
    assert {k: v for k, v in found.items() if v != "read"} == {"cut.txt": "cut short", "none.txt": "unreadable"}
    assert {"bom.txt", "mix.txt", "whole.txt"} <= {k for k, v in found.items() if v == "read"}
    rows = scan_corpus(spark, root, skip_bad_files=True).collect()
    names = [r.file.rpartition("/")[2] for r in rows]
    assert "cut.txt" not in names and "none.txt" not in names and names.count("whole.txt") == 400 and names.count("A.TXT") == 5
    order = {r.file.rpartition("/")[2]: r.file_order for r in list_files(spark, root).collect()}
    for name in ("whole.txt", "z.txt"):  # those left out keep their place in the order
        own = sorted((r.sequence, r.line_num) for r in rows if r.file.endswith(f"/{name}"))
        assert own == [(order[name] * 2_000_000 + i + 1, i) for i in range(len(own))]


def test_order_of_many_files_takes_no_single_task(spark):
    plan_of = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    names = spark.range(100_000).select(F.concat(F.lit("/d/f"), F.lpad(F.col("id").cast("string"), 6, "0"), F.lit(".txt")).alias("file"))
    numbered = number_rows(names, [F.split("file", "/"), "file"], (), "file_order")
    assert "windowspecdefinition" not in plan_of(numbered)
    assert numbered.where("file_order <> CAST(substring(file, 5, 6) AS BIGINT)").isEmpty()
