"""Objects of events: cases worked by hand."""

from chronoloom.operators import filters, rollup


def test_what_an_object_takes_from_its_events(spark):
    columns = "objid long, eventid long, classification string, image_sig_max double, camera int, flux_max double, frame_duration int, mjd_duration double, flux_sign int, asteroid_id long, note string"
    rows = [
        (1, 1, "Asteroid", 5.0, 2, 9.0, 3, 0.5, 1, 7, "a"),  # the only event: its asteroid counts
        (2, 1, "Asteroid", 9.0, 2, 1.0, 3, 0.5, 1, 8, "b"), (2, 2, "Asteroid", 9.0, 3, 2.0, 9, 0.1, -1, 9, "c"),  # equal: the first; two events: no asteroid
        (3, 1, "RRLyrae", None, 1, 3.0, 1, 0.2, 1, 0, "d"), (3, 2, "-", 1.0, 4, 4.0, 2, 0.3, 1, 0, "e"), (3, 3, "RRLyrae", 0.5, 5, 5.0, 4, 0.4, 1, 0, "f"),
        (4, 1, "b", 1.0, 1, 1.0, 1, 0.1, -1, None, None), (4, 2, "a", 2.0, 1, 1.0, 1, 0.1, -1, None, None),  # equally frequent: the least
        (5, 1, "Asteroid", None, 1, 1.0, 1, 0.1, 1, None, None),
    ]
    got = {r.objid: r for r in rollup.find_objects(spark.createDataFrame(rows, columns), more=["note"]).collect()}
    assert [(got[i].classification, got[i].asteroid_id, got[i].cam, got[i].flux_maxsig, got[i].note, got[i].flux_sign, got[i].n_events) for i in range(1, 6)] == [
        ("Asteroid", "7", 2, 9.0, "a", 1, 1), ("Asteroid", "-", 2, 1.0, "b", 0, 2), ("VRRLyr", "-", 4, 4.0, "e", 1, 3), ("a", "-", 1, 1.0, None, -1, 2), ("Asteroid", "-", 1, 1.0, None, 1, 1)]
    assert (got[3].min_eventlength_frame, got[3].max_eventlength_frame, got[3].min_eventlength_mjd, got[3].max_eventlength_mjd) == (1, 4, 0.2, 0.4)
    assert rollup.find_objects(spark.createDataFrame([], columns)).count() == 0


def test_events_away_from_boundaries(spark):
    rows = [(1, 1, 6, 9), (2, 1, 5, 5), (3, 1, 90, 94), (4, 1, 90, 95), (5, 4, 2, 3), (6, 4, 1, 1), (7, 24, 0, 0), (8, 24, 1, 9)]
    e = spark.createDataFrame([(i, b, s, z, "-", 1) for i, b, s, z in rows], "id int, frame_bin int, frame_start int, frame_end int, classification string, total_events int")
    kept = filters.filter_events(e, boundary_buffer=5, boundaries={1: (0, 100), 4: (0, 25), 24: (0,)})
    assert sorted(r.id for r in kept.collect()) == [1, 3, 5, 8]
