"""Command line: rank a text edge list and write the ranks.

    spark-submit --py-files vertexrank.zip vertexrank/__main__.py INPUT OUTPUT EPS [options]
    python -m vertexrank INPUT OUTPUT EPS --master local[8] [options]

INPUT is one or more TAB-separated edge files, comma-separated (``src<TAB>dst``,
quotes optional, id ``0`` dropped; malformed lines are dropped and counted). Ranks are written to OUTPUT in ascending order;
the iteration count, the L1 change per step and the wall time go to stdout.
"""

from __future__ import annotations

import argparse
import json
import time

from vertexrank.operators.rank import rank
from vertexrank.session import build_session
from vertexrank.sources.edges import edge_line_report, read_edge_lines, read_edges, store_edge_lines
from vertexrank.sources.sinks import FORMATS, write_ranks


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="vertexrank", description=__doc__.split("\n")[0])
    p.add_argument("input")
    p.add_argument("output")
    p.add_argument("eps", type=float, help="stop when the L1 change is at most this")
    p.add_argument("--dangling", choices=("self_loop", "redistribute"), default="self_loop")
    p.add_argument("--prune-sources", action="store_true", help="take vertices without in-edges out of the loop")
    p.add_argument("--strategy", choices=("shuffle", "broadcast"), default="shuffle")
    p.add_argument("--max-iter", type=int, default=None, help="iteration cap (default: none)")
    p.add_argument("--damping", type=float, default=0.85)
    p.add_argument("--format", choices=FORMATS, default="tuple")
    p.add_argument("--partitions", type=int, default=None)
    p.add_argument("--history", default=None, help="folder for per-iteration ranks (parquet)")
    p.add_argument("--resume", action="store_true", help="go on from the last finished iteration in --history")
    p.add_argument("--dense-ids", action="store_true", help="run the loop on numbers from a dictionary of the ids")
    p.add_argument("--order-free", action="store_true", help="sums that do not depend on the partitions")
    p.add_argument("--rejects", default=None, help="folder for the lines of the input: edges, and rejected lines with the reason")
    p.add_argument("--part-bytes", type=int, default=None, help="size of an output file")
    p.add_argument("--master", default=None, help="only when not launched by spark-submit")
    args = p.parse_args(argv)

    start = time.time()
    spark = build_session(args.master)
    paths = args.input.split(",")
    if args.rejects:  # one scan gives edges and rejected lines
        edges, rejects = store_edge_lines(read_edge_lines(spark, paths), args.rejects)
        counts = {r["problem"]: r["count"] for r in rejects.groupBy("problem").count().collect()}
        report = {"malformed": counts.get("malformed", 0), "sentinel": counts.get("sentinel", 0)}
    else:
        edges = read_edges(spark, paths)
        lines = edge_line_report(read_edge_lines(spark, paths)).first()
        report = {"lines": lines["n_lines"], "malformed": lines["n_malformed"]}
    res = rank(
        edges,
        dangling=args.dangling,
        prune_sources=args.prune_sources,
        strategy=args.strategy,
        damping=args.damping,
        tol=args.eps,
        max_iter=args.max_iter,
        num_partitions=args.partitions,
        history_path=args.history,
        resume=args.resume,
        dense_ids=args.dense_ids,
        order_free=args.order_free,
    )
    write_ranks(res.ranks, args.output, fmt=args.format, part_bytes=args.part_bytes)
    print(
        json.dumps(
            {
                "iterations": res.iterations,
                "converged": res.converged,
                "deltas": res.deltas,
                **report,
                "wall_ms": int((time.time() - start) * 1000),
            }
        )
    )


if __name__ == "__main__":
    main()
