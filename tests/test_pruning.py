"""Pruning by tasks against going through the plan one by one."""

import os

import pytest

from threadloom.sources import pruning as m


def stage(tmp, n=30):
    root = tmp / "stage"
    for i in range(n):
        d = root / f"{i % 3:02x}" / str(i)
        d.mkdir(parents=True)
        (d / "page.html").write_text(str(i))
    return root


def plan_of(spark, rows):
    return spark.createDataFrame(rows, "post_id long, path string, problem string").repartition(4)


def paths(n=30):
    return [(i, f"{i % 3:02x}/{i}", None) for i in range(n)]


def by_order(rows, bad):
    """path -> status, going through the plan in order."""
    out, stopped = {}, False
    for _, path, _ in sorted(rows, key=lambda r: r[1]):
        out[path] = "kept" if stopped else "failed" if path in bad else "removed"
        stopped |= path in bad
    return out


def left(root):
    return {f"{a.name}/{b.name}" for a in root.iterdir() for b in a.iterdir()}


@pytest.mark.parametrize("bad", [[], ["01/16"], ["01/16", "01/7", "00/0"], ["02/8"]])
@pytest.mark.parametrize("how", ["planned", "missing", "move"])
def test_first_failure_keeps_the_rest(spark, tmp_path, bad, how):
    root, rows = stage(tmp_path), paths()
    move = m.Place.move
    if how == "planned":
        rows = [(i, p, "not a page" if p in bad else None) for i, p, _ in rows]
    elif how == "missing":
        for p in bad:
            os.remove(root / p / "page.html")
            os.rmdir(root / p)
    else:
        names = set(bad)

        def move(place, source, target):
            return "no leave" if "/".join(source.split("/")[-2:]) in names else place.move(source, target)

    got = m.prune(plan_of(spark, rows), f"file://{root}", f"file://{tmp_path}/journal", move).collect()
    want = by_order(rows, bad)
    assert {r.path: r.status for r in got} == want
    assert {r.error for r in got if r.status == "failed"} <= {"not a page", "nothing there", "no leave"}
    gone = {p for p, s in want.items() if s == "removed"} | (set(bad) if how == "missing" else set())
    assert left(root) == {p for _, p, _ in rows} - gone and not os.path.exists(f"{root}.trash")
    for p in left(root):
        assert (root / p / "page.html").read_text() == p.split("/")[1]


def test_a_run_that_died_goes_on(spark, tmp_path):
    root, rows = stage(tmp_path), paths()

    def dies(place, source, target):
        if source.endswith("/16"):
            raise KeyError("died")
        return place.move(source, target)

    with pytest.raises(Exception, match="died"):
        m.prune(plan_of(spark, rows), f"file://{root}", f"file://{tmp_path}/journal", dies)
    assert os.path.exists(f"{root}.trash") and "01/16" in left(root)
    got = m.prune(plan_of(spark, rows[:1]), f"file://{root}", f"file://{tmp_path}/journal").collect()  # the journal's plan counts
    assert len(got) == 30 and {r.status for r in got} == {"removed"} and left(root) == set()


def test_what_lies_outside_stays(spark, tmp_path):
    root = stage(tmp_path, 3)
    (tmp_path / "other").mkdir()
    os.symlink(tmp_path / "other", root / "00/link")
    for path in ["../other", "/etc", "00/../../other", "00/link", "", None]:
        got = m.prune(plan_of(spark, [(1, path, None)]), str(root), f"{tmp_path}/journal-{abs(hash(path))}").collect()
        assert [r.status for r in got] == ["failed"] and (tmp_path / "other").exists()
    assert m.prune(plan_of(spark, []), str(root), f"{tmp_path}/empty").collect() == []
