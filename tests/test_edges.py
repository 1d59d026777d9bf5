from vertexrank.sources.edges import (
    edge_line_report,
    edges_from_table,
    normalize_edges,
    parse_edge_lines,
    read_edges,
)

# T5: raw lines and what becomes of them
T5_LINES = [
    '"1"\t"2"',  # 1 -> 2
    "1\t2\textra",  # same edge, third field ignored
    "2\t3",  # 2 -> 3
    '"0"\t3',  # sentinel after unquoting: dropped
    '""4""\t1',  # all outer quotes stripped: 4 -> 1
    '"a b"\t 6',  # spaces kept: "a b" -> " 6"
    "7\t\tx",  # 7 -> "" (empty id)
    "\t5",  # "" -> 5
    "7\t",  # malformed
    "5",  # malformed
    "",  # malformed
]
T5_EDGES = {("1", "2"), ("2", "3"), ("4", "1"), ("a b", " 6"), ("7", ""), ("", "5")}


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_parse_and_normalize_t5(spark):
    lines = lines_df(spark, T5_LINES)
    parsed = parse_edge_lines(lines)
    assert parsed.count() == 8
    got = {(r.src, r.dst) for r in normalize_edges(parsed).collect()}
    assert got == T5_EDGES


def test_line_report_counts_malformed(spark):
    row = edge_line_report(lines_df(spark, T5_LINES)).first()
    assert (row.n_lines, row.n_malformed, row.n_parsed, row.n_sentinel) == (11, 3, 8, 1)


def test_read_edges_from_text_file(spark, tmp_path):
    path = tmp_path / "edges.txt"
    path.write_text("\n".join(T5_LINES) + "\n")
    got = {(r.src, r.dst) for r in read_edges(spark, str(path)).collect()}
    assert got == T5_EDGES


def test_sentinel_off_keeps_zero(spark):
    lines = lines_df(spark, ['"0"\t3', "1\t2"])
    got = {(r.src, r.dst) for r in normalize_edges(parse_edge_lines(lines), sentinel=None).collect()}
    assert got == {("0", "3"), ("1", "2")}


def test_edges_from_table_keeps_type_and_drops_nulls(spark):
    t = spark.createDataFrame(
        [(1, 2, "x"), (1, 2, "y"), (0, 5, "z"), (3, None, "w"), (3, 3, "v")], "a long, b long, c string"
    )
    e = edges_from_table(t, "a", "b")
    assert dict(e.dtypes) == {"src": "bigint", "dst": "bigint"}
    # a key table has no sentinel unless one is named
    assert {(r.src, r.dst) for r in e.collect()} == {(0, 5), (1, 2), (3, 3)}
    assert {(r.src, r.dst) for r in edges_from_table(t, "a", "b", sentinel=0).collect()} == {(1, 2), (3, 3)}


def test_parse_plan_has_no_python(spark):
    plan = parse_edge_lines(lines_df(spark, T5_LINES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_rejected_lines_are_kept_and_edges_come_from_the_same_scan(spark, tmp_path):
    from vertexrank.plans.inspect import plan_text
    from vertexrank.sources.edges import sort_edge_lines, store_edge_lines

    rows = ['"1"\t"2"', "1\t2\textra", '"0"\t3', "3\t0", "5", "", "7\t", "\t5", None, "1\t2"]
    lines = spark.createDataFrame([(x,) for x in rows], "value string")
    edges, rejects = store_edge_lines(lines, str(tmp_path / "s"))
    assert sorted(map(tuple, edges.collect())) == [("", "5"), ("1", "2")]
    assert sorted(map(tuple, rejects.collect()), key=repr) == sorted(
        [('"0"\t3', "sentinel"), ("3\t0", "sentinel"), ("5", "malformed"), ("", "malformed"), ("7\t", "malformed"), (None, "malformed")], key=repr
    )
    assert plan_text(sort_edge_lines(lines)).count("Scan") == 1
    shown = plan_text(rejects)
    assert "PartitionFilters: [isnotnull(outcome" in shown, shown
    everything, nothing = store_edge_lines(lines.limit(0), str(tmp_path / "e"))
    assert everything.count() == nothing.count() == 0
