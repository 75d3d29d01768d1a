"""Documents as files in their folders."""

import os

import pytest
from pyspark.sql import functions as F

from winnow.operators.documents import write_document_files
from winnow.sources.files import write_files


def files_of(root):
    """Files in their places; a task that outlives its run may leave a hidden folder."""
    found = {}
    for folder, folders, names in os.walk(root):
        folders[:] = [f for f in folders if not f.startswith("_staging")]
        for name in names:
            path = os.path.join(folder, name)
            with open(path, "rb") as f:
                found[os.path.relpath(path, root)] = f.read()
    return found


def test_bodies_byte_by_byte(spark, tmp_path):
    bodies = {("acme_TD", "cover"): "a\r\nb é \u2028", ("acme_TD", "cv"): "", ("Ünï_漢", "cover"): "x" * 3_000_000, ("n_1", "cv"): None}
    rows = [(i, f, k, b, "more") for i, ((f, k), b) in enumerate(bodies.items())]
    documents = spark.createDataFrame(rows, "id int, folder string, kind string, body string, name string").repartition(3)
    write_document_files(documents, str(tmp_path))
    want = {f"{f}/{k}.tex": (b or "").encode() for (f, k), b in bodies.items()}
    assert files_of(tmp_path) == want and not [d for d in os.listdir(tmp_path) if d.startswith("_")]
    # a later run replaces its own files and leaves the others; the folder may be given as an address
    again = documents.where("folder = 'n_1'").withColumn("body", F.lit("new"))
    write_document_files(again, f"file://{tmp_path}")
    assert files_of(tmp_path) == want | {"n_1/cv.tex": b"new"}
    write_document_files(documents.limit(0), str(tmp_path))
    assert files_of(tmp_path) == want | {"n_1/cv.tex": b"new"}


def test_many_files_of_many_tasks(spark, tmp_path):
    rows = spark.range(0, 2_000, 1, 8).select(
        F.concat_ws("/", F.col("id") % 37, F.col("id")).alias("name"), F.col("id").cast("string").alias("body")
    )
    write_files(rows, str(tmp_path))
    assert files_of(tmp_path) == {f"{i % 37}/{i}": str(i).encode() for i in range(2_000)}


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    (tmp_path / "kept.tex").write_text("old")
    body = F.when(F.col("id") == 900, F.raise_error(F.lit("cannot be typeset"))).otherwise(F.col("id").cast("string"))
    rows = spark.range(0, 1_000, 1, 8).select(F.concat(F.lit("f/"), F.col("id")).alias("name"), body.alias("body"))
    with pytest.raises(Exception, match="cannot be typeset"):
        write_files(rows, str(tmp_path))
    assert files_of(tmp_path) == {"kept.tex": b"old"}


@pytest.mark.parametrize("name", ["../x", "a//b", "", "/etc/x", "a/."])
def test_names_that_leave_the_folder(spark, tmp_path, name):
    with pytest.raises(Exception, match="not a name"):
        write_files(spark.createDataFrame([("ok", "1"), (name, "2")], "name string, body string"), str(tmp_path))
    assert files_of(tmp_path) == {}


def test_folders_that_coincide_are_refused(spark, tmp_path):
    rows = [(1, "a_TD", "cv", "x"), (2, "a_TD", "cv", "y"), (3, "b", "cv", "z")]
    documents = spark.createDataFrame(rows, "id int, folder string, kind string, body string")
    with pytest.raises(ValueError, match="2 rows have the name 'a_TD/cv.tex'"):
        write_document_files(documents, str(tmp_path))
    assert files_of(tmp_path) == {}
