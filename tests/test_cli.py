import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_command_line_ranks_a_text_file(tmp_path):
    src = tmp_path / "edges.txt"
    src.write_text('"1"\t"2"\n1\t3\n2\t3\n4\t1\n7\t\n0\t5\n')
    out = tmp_path / "ranks"
    proc = subprocess.run(
        [sys.executable, "-m", "vertexrank", str(src), str(out), "1e-9",
         "--master", "local[2]", "--dangling", "redistribute", "--partitions", "1"],
        cwd=REPO, capture_output=True, text=True, timeout=600,
    )
    assert proc.returncode == 0, proc.stderr[-2000:]
    report = json.loads(proc.stdout.strip().splitlines()[-1])
    assert report["iterations"] > 10 and report["deltas"][-1] <= 1e-9
    lines = []
    for name in sorted(os.listdir(out)):
        if name.startswith("part-"):
            lines += (out / name).read_text().splitlines()
    got = {v: float(r) for v, r in (line[1:-1].rsplit(",", 1) for line in lines)}
    expected = {"1": 0.931895, "2": 0.899782, "3": 1.664597, "4": 0.503727}
    assert set(got) == set(expected)
    assert all(abs(got[k] - expected[k]) < 1e-6 for k in expected)
    assert [got[k] for k in ("4", "2", "1", "3")] == sorted(got.values())  # ascending order
