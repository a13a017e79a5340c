"""Covers of large support relations are made in bounded parts."""

from tidewatch.operators import planner


def test_cover_is_made_in_bounded_parts(spark, monkeypatch, tmp_path):
    pairs = {(f"r{i % 150}", f"t{i % 7}") for i in range(1050)}
    real, log = planner.greedy_cover, str(tmp_path / "sizes")

    def noted(part):
        part = set(part)
        with open(log, "a") as f:
            f.write(f"{len({r for r, _ in part})} {len({t for _, t in part})}\n")
        return real(part)

    monkeypatch.setattr(planner, "greedy_cover", noted)
    rows = planner.covering_requests(spark.createDataFrame(sorted(pairs), "RegionCode string, InstanceType string")).collect()
    assert all(len(r["regions"]) <= 8 and len(r["types"]) <= 5 for r in rows)
    assert pairs <= {(x, y) for r in rows for x in r["regions"] for y in r["types"]}
    with open(log) as f:
        sizes = [tuple(map(int, x.split())) for x in f]
    assert len(sizes) >= 3 and all(a <= 64 and b <= 1000 for a, b in sizes)
