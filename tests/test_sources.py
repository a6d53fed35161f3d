"""Sources and sinks: delimited text, headers, unions, run directories, images, models."""

import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import column
from eigenlake.operators.preprocess import Preprocessor
from eigenlake.operators.spectral import fit_pca, fit_svd
from eigenlake.sources import images, models, records, sinks, tables


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("separator", [",", ";", "\t", "|"])
def test_separator_is_detected(spark, tmp_path, separator):
    text = "\n".join(separator.join(r) for r in (["a", "b", "c"], ["1", "2.5", "x"], ["3", "4", "y"]))
    df = tables.read_table(spark, write(tmp_path / "t.csv", text))
    assert df.dtypes == [("a", "bigint"), ("b", "double"), ("c", "string")]
    assert sorted(map(tuple, df.collect())) == [(1, 2.5, "x"), (3, 4.0, "y")]


def test_types_come_from_all_cells(spark, tmp_path):
    text = " a ,flag,mixed,when\n1,True,1,2024-01-01\nNA,False,x,2024-01-02\n-3.5e1,true,2,2024-01-03\n"
    df = tables.read_table(spark, write(tmp_path / "t.csv", text))
    assert df.dtypes == [("a", "double"), ("flag", "boolean"), ("mixed", "string"), ("when", "string")]
    assert [r["a"] for r in df.collect()] == [1.0, None, -35.0]


@pytest.mark.parametrize(
    "text, message",
    [("a,a,b\n1,2,3\n", "duplicate"), ("a, a\n1,2\n", "duplicate"), ("", "empty"), ("   \n", "empty"), ("a,b\n", "empty")],
)
def test_bad_headers_and_empty_files(spark, tmp_path, text, message):
    with pytest.raises(ValueError, match=message):
        tables.read_table(spark, write(tmp_path / "bad.csv", text))


def test_missing_path_and_directory(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "none.csv"))
    (tmp_path / "folder").mkdir()
    with pytest.raises(ValueError, match="empty"):
        tables.read_table(spark, str(tmp_path / "folder"))


def test_folders_globs_lists_and_separators(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, value in (("a.csv", "1~x"), ("b.csv", "2~y")):
        write(tmp_path / "in" / name, f"k~v\n{value}\n")
    write(tmp_path / "in" / "_SUCCESS", "")
    folder = str(tmp_path / "in")
    for path in (folder, f"{folder}/*.csv", [f"{folder}/a.csv", f"{folder}/b.csv"]):
        rows = tables.read_table(spark, path, sep="~").collect()
        assert sorted(map(tuple, rows)) == [(1, "x"), (2, "y")]
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, f"{folder}/*.txt")


def test_late_quoted_line_break(spark, tmp_path):
    lines = "".join(f"{i},plain\n" for i in range(60)) + '60,"two\nlines"\n'
    rows = tables.read_table(spark, write(tmp_path / "late.csv", "k,v\n" + lines)).collect()
    assert len(rows) == 61 and {r["v"] for r in rows} == {"plain", "two\nlines"}


def cells(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_columns_go_by_name_over_files(spark, tmp_path):
    folder = tmp_path / "some files"
    folder.mkdir()
    for name, text in {
        "1.csv": "a,b,c\n10,20,x\n",
        "2.csv": "b, a ,c\n21,11,y\n",
        "3.csv": "c,a\nz,12\n",
        "4.csv": "\ufeffd,a,b,c\r\n1.5,13,23,\r\n",
        "5.csv": "",
        "6.csv": "a,b,c\n14,24,v\n",
    }.items():
        write(folder / name, text)
    df = tables.read_table(spark, str(folder))
    assert df.dtypes == [("a", "bigint"), ("b", "bigint"), ("c", "string"), ("d", "double")]
    expected = [(10, 20, "x", None), (11, 21, "y", None), (12, None, "z", None), (13, 23, None, 1.5), (14, 24, "v", None)]
    assert cells(df, *df.columns) == sorted(expected, key=str)
    # The same with quoted line breaks somewhere.
    write(folder / "7.csv", 'c,b\n"two\nlines",25\n')
    assert cells(tables.read_table(spark, str(folder)), *df.columns) == sorted([*expected, (None, 25, "two\nlines", None)], key=str)
    write(folder / "8.csv", "other;names\n1;2\n")
    with pytest.raises(ValueError, match="No column in common"):
        tables.read_table(spark, str(folder))
    write(folder / "8.csv", "a,b, a\n1,2,3\n")
    with pytest.raises(ValueError, match="duplicate"):
        tables.read_table(spark, str(folder))


def test_open_quotes_follow_the_parser():
    for line, inside, after in [
        ("a,b", False, False), ('a,"b', False, True), ('a,"b"', False, False), ('"a ""b', False, True), ('"a ""b"""', False, False),
        ('5" pipe,"x', False, True), ('5" pipe,x', False, False), ('x",y', True, False), ('x,y', True, True), ('x","y', True, True),
        ('x""', True, True), ("", False, False), ("", True, True), ('"a"b,"c', False, True),
    ]:
        assert records.open_after(line, inside, ",") == after, line


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "400b", "spark.sql.files.openCostInBytes": "1b"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_one_quoted_file_is_read_by_many_tasks(spark, tmp_path, small_blocks, ending):
    rng = random.Random(3)
    rows, out = [], []
    for i in range(400):
        # Some values span several blocks; some look like records of their own.
        size = rng.choice([0, 0, 1, 3, 200 if i % 50 == 0 else 2])
        text = ending.join(rng.choice(["one", 'say ""hi""', "1,2", "", '""', "x,y,z"]) for _ in range(size))
        rows.append((i, text.replace('""', '"'), "end" if i % 3 else 'an "end"'))
        tail = "end" if i % 3 else '"an ""end"""'
        out.append(f'{i},"{text}",{tail}')
    path = tmp_path / "quoted.csv"
    path.write_bytes(ending.join(["k,v,w", *out, ""]).encode())
    lines = records.file_lines(spark, [str(path)])
    assert lines.select("block").distinct().count() > 20 and records.inner_starts(lines, ",")
    found = tables.read_table(spark, str(path))
    expected = [(k, v if v.strip(" ") else None, w) for k, v, w in rows]
    assert cells(found, "k", "v", "w") == sorted(expected, key=str)
    whole = spark.read.csv(str(path), header=True, multiLine=True, escape='"')
    assert cells(found.selectExpr("string(k) k", "v", "w"), "k", "w") == cells(whole, "k", "w")


def test_records_of_other_shapes(spark, tmp_path):
    # A quote within a value, a file without a last line end, an open quote at the end, carriage returns alone.
    assert cells(tables.read_table(spark, write(tmp_path / "a.csv", 'k,v\n1,5" pipe\n2,"a\nb"')), "k", "v") == [(1, '5" pipe'), (2, "a\nb")]
    assert cells(tables.read_table(spark, write(tmp_path / "b.csv", "k,v\r1,x\r2,y\r")), "k", "v") == [(1, "x"), (2, "y")]
    assert cells(tables.read_table(spark, write(tmp_path / "c.csv", "k:v\n1:x\n2:y\n")), "k", "v") == [(1, "x"), (2, "y")]
    assert tables.detect_separator(["mean.x", "1.5", "2.5"]) == ","


def test_labelled_union_keeps_duplicates(spark):
    one = spark.createDataFrame([(1, 2.0), (1, 2.0)], "a int, b double")
    two = spark.createDataFrame([(3.0, 4)], "b double, a int")
    rows = tables.combine_labelled({"red": one, "white": two}, "kind").collect()
    assert sorted((r["a"], r["b"], r["kind"]) for r in rows) == [(1, 2.0, "red"), (1, 2.0, "red"), (4, 3.0, "white")]


def test_run_directories_never_repeat(spark, tmp_path):
    paths = {sinks.create_run_directory(spark, str(tmp_path), "pca") for _ in range(3)}
    assert len(paths) == 3 and all("_pca" in p for p in paths)


def test_coordinates_and_metrics_written(spark, tmp_path):
    df = spark.createDataFrame([(1, [0.5, 2.0])], "row_id bigint, reduced array<double>")
    table = sinks.coordinates(df, 2, keep=["row_id"])
    assert table.columns == ["row_id", "component_1", "component_2"]
    sinks.write_coordinates(table, str(tmp_path / "c"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == table.columns
    sinks.write_metrics(spark.createDataFrame([("m", 1.0)], "metric string, value double"), str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).first()["value"] == 1.0
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        sinks.write_metrics(spark.createDataFrame([("m", 1.0)], "metric string, value double"), str(tmp_path / "m"))


@pytest.mark.parametrize("fit, name", [(fit_pca, "pca"), (fit_svd, "svd")])
def test_model_round_trip(spark, tmp_path, matrix_frame, fit, name):
    x = np.random.default_rng(0).normal(size=(60, 4)) * [4, 2, 1, 0.5]
    df = matrix_frame(x)
    model = fit(df, n_components=2)
    path = str(tmp_path / name)
    models.save_model(spark, model, path)
    back = models.load_model(spark, path)
    assert back.method == name and back.count == 2 and back.rows_seen == 60
    before, after = (column(m.transform(df), "reduced") for m in (model, back))
    np.testing.assert_allclose(before, after, atol=1e-15)
    np.testing.assert_allclose(back.cumulative, model.cumulative)
    cells_of = spark.read.parquet(f"{path}/components")
    cells_of.where("pos < 3").write.parquet(f"{path}-cut/components")
    for part in ("metadata", "mean", "spectrum"):
        spark.read.parquet(f"{path}/{part}").write.parquet(f"{path}-cut/{part}")
    with pytest.raises(ValueError, match="lacks cells"):
        models.load_model(spark, f"{path}-cut")
    with pytest.raises(ValueError, match="not a"):
        models.load_model(spark, path, expected="svd" if name == "pca" else "pca")


def test_unknown_model_type(spark, tmp_path):
    bad = [("ica", 1, 0.9, 1, 2, 3)]
    spark.createDataFrame(bad, models.METADATA_SCHEMA).write.parquet(str(tmp_path / "m/metadata"))
    with pytest.raises(ValueError, match="Unsupported model type"):
        models.load_model(spark, str(tmp_path / "m"))


def test_preprocessor_round_trip_and_checks(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 4.0), (2.0, 6.0), (3.0, 8.0)], "a double, b double")
    state = Preprocessor.fit(df, ["a", "b"])
    models.save_preprocessor(spark, state, str(tmp_path / "p"))
    assert models.load_preprocessor(spark, str(tmp_path / "p")) == state
    table = state.state_table(spark)
    with pytest.raises(ValueError, match="invalid scales"):
        Preprocessor.from_state_table(table.withColumn("scale", F.lit(0.0)))
    with pytest.raises(ValueError, match="non-finite"):
        Preprocessor.from_state_table(table.withColumn("mean", F.lit(float("nan"))))
    with pytest.raises(ValueError, match="inconsistent"):
        Preprocessor.from_state_table(table.where("pos > 0"))


def png(cube):
    height, width, _ = cube.shape
    raw = b"".join(b"\x00" + row.tobytes() for row in cube)

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    header = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_image_planes(spark, tmp_path):
    cube = np.random.default_rng(3).integers(0, 256, (6, 5, 3), dtype=np.uint8)
    (tmp_path / "i.png").write_bytes(png(cube))
    planes = images.read_image_planes(spark, str(tmp_path / "i.png"))
    for channel in range(3):
        got = column(planes.where(F.col("channel") == channel), "pixels", "row_idx")
        np.testing.assert_allclose(got, cube[:, :, channel] / 255.0)


def test_pixel_checks(spark):
    rows = spark.createDataFrame([([0, 255],)], "pixels array<int>")
    assert images.normalise_pixels(rows, "uint8").first()["pixels"] == [0.0, 1.0]
    for values, message in (([0.2, 1.4], "normalized"), ([0.2, float("nan")], "NaN"), ([], "empty")):
        bad = spark.createDataFrame([(values,)], "pixels array<double>")
        with pytest.raises(ValueError, match=message):
            images.normalise_pixels(bad)
