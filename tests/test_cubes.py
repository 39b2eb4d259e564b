"""Cubes read by ranges of frames."""

import numpy as np
import pytest

from chronoloom.sources import cubes


def test_ranges_of_frames(spark, tmp_path):
    rng = np.random.default_rng(1)
    made = {"a_ReducedFlux.npy": rng.normal(size=(37, 5, 4)).astype("<f4"), "sub/b.npy": rng.integers(0, 9, (3, 2, 6)).astype(">i2"), "c.npy": rng.normal(size=(6, 3)), "a_Times.npy": 59000 + np.arange(37) / 86400 / 7, "none.npy": np.zeros((0, 4, 4))}
    (tmp_path / "sub").mkdir()
    for name, array in made.items():
        np.save(tmp_path / name, array)
    (tmp_path / "other.txt").write_text("x")
    df = cubes.read_cubes(spark, str(tmp_path), partition_bytes=5 * 4 * 4 * 10)
    assert df.rdd.getNumPartitions() > 4
    got = {}
    for r in df.collect():
        got.setdefault(r.path.removeprefix(str(tmp_path) + "/"), {})[r.frame] = np.array(r.img, dtype=np.float32).reshape(r.ny, r.nx)
    assert set(got) == set(made) - {"none.npy"}
    for name in ("a_ReducedFlux.npy", "sub/b.npy", "c.npy"):
        cube = made[name] if made[name].ndim == 3 else made[name][None]
        assert len(got[name]) == len(cube) and all((got[name][i] == cube[i].astype(np.float32)).all() for i in range(len(cube)))
    cut = cubes.gather_cut(spark, f"file:{tmp_path}/a")
    assert set(cut) == {"flux", "time"} and cut["flux"].count() == 37
    assert [r.time for r in cut["time"].orderBy("frame").collect()] == made["a_Times.npy"].tolist()
    assert cubes.read_cubes(spark, str(tmp_path / "none.npy")).count() == 0


def test_what_is_not_a_cube(spark, tmp_path):
    np.save(tmp_path / "f.npy", np.asfortranarray(np.zeros((3, 4, 5))))
    with pytest.raises(Exception, match="row by row"):
        cubes.read_cubes(spark, str(tmp_path / "f.npy")).count()
    with open(tmp_path / "g.npy", "wb") as f:
        np.lib.format.write_array_header_1_0(f, {"descr": "<f8", "fortran_order": False, "shape": (9, 2, 2)})
        f.write(b"0" * 100)
    with pytest.raises(Exception, match="ends before"):
        cubes.read_cubes(spark, str(tmp_path / "g.npy")).count()
    with pytest.raises(Exception, match="absent"):
        cubes.read_cubes(spark, str(tmp_path / "absent.npy")).count()
