"""Header cards of extensions, header keys as columns, files without rows, text tables in parts."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from chronoloom.sources import files


def block(*cards: str) -> bytes:
    text = "".join(c.ljust(80) for c in [*cards, "END"])
    return text.ljust(-(-len(text) // 2880) * 2880).encode("latin-1")


@pytest.fixture(scope="module")
def images(tmp_path_factory):
    d = tmp_path_factory.mktemp("images")
    first = block("SIMPLE  =                    T", "BITPIX  =                  -32", "NAXIS   =                    2", "NAXIS1  =                   30", "NAXIS2  =                   40", "NAME    = 'main / one'  / text", *[f"FILL{i:04d}=                    {i}" for i in range(40)])
    second = block("XTENSION= 'IMAGE   '", "BITPIX  =                   16", "NAXIS   =                    1", "NAXIS1  =                    5", "CRPIX1  =               1045.5 / pixel", "COMMENT = not a value")
    third = block("XTENSION= 'TABLE   '", "NAXIS   =                    0", "CRPIX1  =                  7.0")
    data = first + b"\xff" * (-(-30 * 40 * 4 // 2880) * 2880) + second + b"\0" * 2880 + third
    (d / "a.fits").write_bytes(data)
    (d / "b.fits").write_bytes(first)
    (d / "c.fits").write_bytes(b"")  # not listed
    return str(d)


def test_headers_of_extensions(spark, images):
    def of(extension):
        rows = files.read_headers(spark, images, ["CRPIX1", "NAME", "NAXIS", "FILL0039"], extension).collect()
        return {r.path[-6]: r.header for r in rows}

    assert of(0) == {"a": {"NAME": "main / one", "NAXIS": "2", "FILL0039": "39"}, "b": {"NAME": "main / one", "NAXIS": "2", "FILL0039": "39"}}
    assert of(1) == {"a": {"CRPIX1": "1045.5", "NAXIS": "1"}, "b": {}}
    assert of(2)["a"] == {"CRPIX1": "7.0", "NAXIS": "0"} and of(3)["a"] == {}


def test_header_keys_as_columns(spark, images):
    heads = files.read_headers(spark, images, ["CRPIX1", "NAXIS"], 1)
    loose = files.header_columns(heads, ["CRPIX1"], ["NAXIS", "GAIN"], prefix="h_", suffix="_x", skip="skipped", strict=False)
    assert loose.columns == ["path", "header", "h_CRPIX1_x", "h_NAXIS_x", "h_GAIN_x", "skipped"]
    got = {r.path[-6]: (r.h_CRPIX1_x, r.h_NAXIS_x, r.h_GAIN_x, r.skipped) for r in loose.collect()}
    assert got == {"a": ("1045.5", "1", None, False), "b": (None, None, None, True)}
    only = files.header_columns(heads.filter(F.col("path").endswith("a.fits")), ["CRPIX1"], ["GAIN"]).first()
    assert (only.CRPIX1, only.GAIN) == ("1045.5", None)
    with pytest.raises(PySparkException, match="CRPIX1"):
        files.header_columns(heads, ["CRPIX1"]).collect()


def test_files_without_rows(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType())])
    for name, text in {"good.csv": "a,b\n1,2.0\n", "deep/more.csv": "# note\na,b\n3,4.0\nx,y\n", "empty.csv": "", "head.csv": "a,b\n", "bad.csv": "a,b\nx,y\n", "other.txt": ""}.items():
        p = tmp_path / name
        p.parent.mkdir(exist_ok=True)
        p.write_text(text)
    got = {r.path.rsplit("/", 1)[1] for r in files.files_without_rows(spark, str(tmp_path), schema).collect()}
    assert got == {"empty.csv", "head.csv", "bad.csv"}
    assert sorted(r.a for r in files.read_csv_union(spark, str(tmp_path), schema).collect()) == [1, 3]


def test_text_table_in_parts(spark, tmp_path):
    df = spark.range(0, 1000, 1, 5).select("id", (F.col("id") / 4).alias("v"))
    files.write_table(df, str(tmp_path / "t"), {"v": "%.2f"})
    parts = sorted(p for p in (tmp_path / "t").iterdir() if p.name.startswith("part-"))
    lines = [x for p in parts for x in p.read_text().splitlines()]
    assert len(parts) == 6 and lines[0] == "# id v" and lines[1:] == [f"{i} {i / 4:.2f}" for i in range(1000)]
