"""Catalogue matches and hand-down of ids: cases worked by hand and a plain loop in the order of groups."""

import random

from chronoloom.operators import crossmatch, resolve

EVENT = "id long, ra double, dec double, ra_err double, dec_err double, classification string"
STAR = "ordinal long, source string, ra double, dec double, rpmag double, gmag double"


def test_ellipse_wrap_brightness_and_classes(spark):
    events = [
        (1, 359.999, 0.0, 0.001, 0.001, "-"),  # star 1 lies across 0 = 360, two errors off
        (2, 100.0, 60.0, 0.001, 0.001, None),  # star 2 is 0.004 in right ascension, 0.002 on the sky
        (3, 50.0, 10.0, 1e-5, 10.0, "-"),  # a long box: star 3 has no rpmag, star 4 has the worse one, so 4 wins
        (4, 50.0, 10.0, 1e-5, 10.0, "Junk"), (5, 20.0, 0.0, 0.001, 0.001, "-"),  # corner of the box, outside the ellipse
        (6, 80.0, 0.0, None, 0.1, "-"), (7, 80.0, 0.0, 0.0, 0.0, "-"), (8, 70.0, -5.0, 0.01, 0.01, "-"),  # equal stars: the first by ordinal
    ]
    stars = [(1, "a", 0.001, 0.0, 9.0, 9.0), (2, "b", 100.004, 60.0, None, None), (3, "c", 50.0, 12.0, None, 1.0), (4, "d", 50.0, -15.0, 18.0, None), (5, "e", 20.0025, 0.0025, 1.0, 1.0), (6, "f", 80.0, 0.0, 1.0, 1.0), (9, "h", 70.0, -5.0, float("nan"), 3.0), (8, "g", 70.0, -5.0, None, 3.0)]
    got = {r.id: r.gaia_id for r in crossmatch.match_stars(spark.createDataFrame(events, EVENT), spark.createDataFrame(stars, STAR), "id").collect()}
    assert got == {1: "a", 2: "b", 3: "d", 4: "-", 5: "-", 6: "-", 7: "-", 8: "g"}
    none = crossmatch.match_stars(spark.createDataFrame(events[5:7], EVENT), spark.createDataFrame([], STAR), "id").collect()
    assert [r.gaia_id for r in none] == ["-", "-"]


def test_variables_overwrite_by_plain_differences(spark):
    events = spark.createDataFrame([(1, 359.999, 0.0, 0.01, 0.01, "-"), (2, 10.0, 60.0, 0.01, 0.01, "x"), (3, 10.0, 60.0, 0.01, 0.01, "Asteroid")], EVENT)
    variables = spark.createDataFrame([(5, 10.02, 60.02, "late"), (2, 9.98, 60.0, "first"), (1, 0.0, 0.0, "other side"), (0, 10.04, 60.0, "too far")], "ordinal long, ra double, dec double, type string")
    assert {r.id: r.classification for r in crossmatch.match_variables(events, variables, "id").collect()} == {1: "-", 2: "first", 3: "Asteroid"}


def test_catalogues_fold_in_order(spark):
    a = spark.createDataFrame([(10.0, 0.0, "a1"), (10.0001, 0.0, "a2")], "ra double, dec double, name string")
    b = spark.createDataFrame([(10.0004, 0.0, 1), (10.002, 0.0, 2), (10.002, 0.0, 3)], "ra double, dec double, n int")
    c = spark.createDataFrame([(10.0021, 0.0, "c1"), (10.0004, 0.0005, "c2"), (10.01, 0.0, "c3")], "ra double, dec double, name string")
    got = [(r.name, r.n) for r in crossmatch.fold_catalogues([None, a, b, None, c]).collect()]
    assert sorted(got, key=str) == sorted([("a1", None), ("a2", None), (None, 2), (None, 3), ("c2", None), ("c3", None)], key=str)  # c2 is near only to the row that a took out
    assert crossmatch.fold_catalogues([None, None]) is None


def plain_hand_down(rows):
    """Groups in order, each from fine to coarse; a row begins with its own id only if nothing has come."""
    ids = {r[0]: set() for r in rows}
    for w in sorted({r[5] for r in rows}):
        mine = [r for r in rows if r[5] == w]
        for g in sorted({r[4] for r in mine}):
            for i, s, e, b, _, _, moving in sorted((r for r in mine if r[4] == g), key=lambda r: r[3]):
                ids[i] = ids[i] or {i}
                for j, s2, e2, b2, g2, _, _ in mine:
                    if b2 > b and (moving or g2 == g) and s * b <= e2 * b2 + b2 and e * b >= s2 * b2 - b2:
                        ids[j] |= ids[i]
    return ids


def test_hand_down_equals_the_ordered_loop(spark):
    rng = random.Random(14)
    rows = []
    for i in range(600):
        b, w = rng.choice([1, 4, 24]), rng.randrange(12)
        s = rng.randrange(0, 400) // b
        rows.append((i, s, s + rng.randrange(0, 3), b, w * 10 + rng.randrange(3), w, rng.random() < 0.3))
    df = spark.createDataFrame(rows, "id long, s long, e long, b int, g long, w long, m boolean")
    got = {}
    for r in resolve.hand_down(df, "id", "s", "e", "b", "g", "w", "m", 48.0).collect():
        got.setdefault(r.id, set()).add(r.origin)
    want = plain_hand_down(rows)
    assert got == want and sum(len(v) > 1 for v in want.values()) > 50
    assert resolve.hand_down(df.limit(0), "id", "s", "e", "b", "g", "w", "m", 48.0).count() == 0
