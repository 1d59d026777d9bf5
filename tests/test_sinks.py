import glob
import os

from vertexrank.operators import rank, with_positions
from vertexrank.sources.sinks import read_rank_history, read_ranks, write_ranks

from .conftest import Approx, as_dict

T2 = [("1", "2"), ("1", "3"), ("2", "3"), ("4", "1"), ("a,b", "1")]


def test_round_trip_all_formats(spark, edges, tmp_path):
    ranks = rank(edges(T2), max_iter=3).ranks
    expected = as_dict(ranks)
    for fmt in ("tuple", "tsv", "parquet"):
        path = str(tmp_path / fmt)
        write_ranks(ranks, path, fmt=fmt)
        assert as_dict(read_ranks(spark, path, fmt=fmt)) == expected  # exact: text is round-trip safe


def test_text_output_is_globally_ascending(spark, edges, tmp_path):
    ranks = rank(edges(T2), max_iter=3).ranks
    path = str(tmp_path / "out")
    write_ranks(ranks, path, fmt="tuple")
    lines = []
    for part in sorted(glob.glob(os.path.join(path, "part-*"))):
        with open(part) as fh:
            lines += fh.read().splitlines()
    values = [float(x.rsplit(",", 1)[1].rstrip(")")) for x in lines]
    assert values == sorted(values) and len(values) == 5
    assert lines[0].startswith("(") and "(a,b," in "".join(lines)


def test_history_has_every_iteration(spark, edges, tmp_path):
    path = str(tmp_path / "hist")
    res = rank(edges(T2), max_iter=3, prune_sources=True, history_path=path)
    hist = read_rank_history(spark, path)
    assert sorted({r.iteration for r in hist.collect()}) == [0, 1, 2, 3]
    at0 = as_dict(hist.where("iteration = 0"))
    assert set(at0.values()) == {1.0} and len(at0) == 5
    assert Approx(as_dict(res.ranks), 1e-12) == as_dict(hist.where("iteration = 3"))


def test_positions_follow_rank_then_vertex(spark):
    rows = [(f"v{i:03d}", float(i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows, "vertex string, rank double")
    got = [(r.position, r.vertex) for r in with_positions(df, num_partitions=5).collect()]
    expected = sorted(rows, key=lambda x: (x[1], x[0]))
    assert sorted(got) == [(i + 1, v) for i, (v, _) in enumerate(expected)]


def test_part_files_have_the_size_asked_for(spark, tmp_path):
    rows = [(f"vertex-{i:06d}" + "x" * (i % 50), (i * 7919 % 20011) / 7) for i in range(20000)]
    df = spark.createDataFrame(rows, "vertex string, rank double").repartition(3)
    for fmt in ("tsv", "tuple"):
        path, size = str(tmp_path / fmt), 50_000
        write_ranks(df, path, fmt=fmt, part_bytes=size)
        parts = sorted(glob.glob(os.path.join(path, "part-*")))
        sizes = [os.path.getsize(p) for p in parts]
        assert len(parts) == -(-sum(sizes) // size)
        assert max(sizes) <= 1.6 * size and min(sizes) >= 0.4 * size
        lines = [line for p in parts for line in open(p).read().splitlines()]
        value = lambda x: float(x.strip("()").replace(",", "\t").split("\t")[1])
        assert [value(x) for x in lines] == sorted(r for _, r in rows)
        assert as_dict(read_ranks(spark, path, fmt=fmt)) == dict(rows)


def test_part_files_of_few_or_no_rows(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b2", 0.5)], "vertex string, rank double")
    write_ranks(df, str(tmp_path / "one"), fmt="tuple", part_bytes=1 << 20)
    assert len(glob.glob(str(tmp_path / "one" / "part-*"))) == 1
    write_ranks(df, str(tmp_path / "each"), fmt="parquet", part_bytes=1)
    assert as_dict(read_ranks(spark, str(tmp_path / "each"), fmt="parquet")) == {"a": 1.0, "b": 1.0, "b2": 0.5}
    write_ranks(df.limit(0), str(tmp_path / "none"), fmt="tsv", part_bytes=100)
    assert read_ranks(spark, str(tmp_path / "none"), fmt="tsv").count() == 0
