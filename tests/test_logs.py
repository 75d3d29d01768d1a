import random
import re
from contextlib import contextmanager

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalog import logs as catalog_logs
from winnow.operators.logdigest import digest_files, digest_lines
from winnow.plans import stages
from winnow.sources.logs import _outlines, log_lines, read_log_lines, read_logs
from winnow.sources.tables import stored


def expected(lines):
    hits = [
        (i, "error", line.strip(), lines[i + 1].strip() if i + 1 < len(lines) else None)
        for i, line in enumerate(lines)
        if line.startswith("!")
    ]
    n = len(lines)
    return hits or [(i, "tail", lines[i].strip(), None) for i in range(max(0, n - 10), n)]


def digests(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.file, []).append((r.line_no, r.kind, r.line, r.context))
    return {k: sorted(v) for k, v in out.items()}


def test_digest(spark, tmp_path):
    texts = {
        "a.log": "ok\n! Undefined\nl.5 \\foo \nx\n",
        "b.log": "\n".join(str(i) for i in range(12)),
        "c.log": "! one\r\n! two\r\rlast !\r\n",
        "d.log": "",
        "e.log": "only\xa0\n\n",
    }
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "f.log").write_bytes(b"! bad \xff byte\nnext")
    (tmp_path / "g.txt").write_text("! not a log")
    files = read_logs(spark, str(tmp_path))
    by_file = {k.rsplit("/", 1)[1]: v for k, v in digests(digest_files(files)).items()}
    by_line = {k.rsplit("/", 1)[1]: v for k, v in digests(digest_lines(log_lines(files))).items()}
    assert by_file["a.log"] == [(1, "error", "! Undefined", "l.5 \\foo")]
    assert by_file["b.log"] == [(i, "tail", str(i), None) for i in range(2, 12)]
    assert by_file["c.log"] == [(0, "error", "! one", "! two"), (1, "error", "! two", "")]
    assert "d.log" not in by_file and "g.txt" not in by_file
    assert by_file["e.log"] == [(0, "tail", "only", None), (1, "tail", "", None)]
    assert by_file["f.log"] == [(0, "error", "! bad � byte", "next")]
    assert by_line == by_file


def test_lines_of_one_hot_file(spark):
    rnd = random.Random(1)
    files = {f"f{i}": [rnd.choice(["ok", " x ", "! e", "", "!"]) if i % 2 else "fine" for _ in range(rnd.randrange(1, 30))] for i in range(40)}
    files["hot"] = ["! e" if i % 97 == 0 else f"l{i}" for i in range(5000)]
    rows = [(f, i, line) for f, lines in files.items() for i, line in enumerate(lines)]
    rnd.shuffle(rows)
    lines = spark.createDataFrame(rows, "file string, line_no long, line string").repartition(8)
    assert digests(digest_lines(lines)) == {f: expected(lines) for f, lines in files.items()}


def test_lines_are_looked_up_without_a_window(spark):
    """Files of many lines: what is wanted is found by number, in one reading of the text."""
    lines = spark.range(0, 40_000, 1, 8).select(
        (F.col("id") % 2).alias("file"), (F.col("id") / 2).cast("long").alias("line_no"),
        F.when((F.col("id") % 2 == 0) & (F.col("id") % 10_000 == 9_998), "! bad").otherwise(F.col("id").cast("string")).alias("line"),
    )
    found = digest_lines(lines)
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
    rows = sorted((r.file, r.line_no, r.kind, r.line, r.context) for r in found.collect())
    assert rows[:4] == [(0, n, "error", "! bad", str(2 * n + 2) if n < 19_999 else None) for n in (4999, 9999, 14999, 19999)]
    assert rows[4:] == [(1, n, "tail", str(2 * n + 1), None) for n in range(19_990, 20_000)]


@contextmanager
def ranges_of(spark, size):
    """Files are read in ranges of so many bytes."""
    conf = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def plain_lines(data):
    lines = re.split(rb"\r\n|\r|\n", data)
    return [x.decode("utf-8", "replace") for x in (lines[:-1] if lines[-1] == b"" else lines)]


@pytest.mark.parametrize("size", [3, 7, 40])
def test_lines_of_ranges(spark, tmp_path, size):
    """Every kind of break, byte and character at the edge of a range, files without a last break, empty ones."""
    draw = random.Random(size)
    marks = [b"!", b"! e", b" x ", b"\r", b"\n", b"\r\n", b"\n\n", b"\xff", "é".encode(), b"long " * 5]
    data = {f"{i}.log": b"".join(draw.choices(marks, k=draw.randrange(60))) for i in range(12)}
    data |= {"none.log": b"", "break.log": b"\n", "one.log": b"! one", "cr.log": b"a\r" * 30, "crlf.log": b"\r\n" * 30, "edge.log": b"ab\r\n" * 20}
    for name, body in data.items():
        (tmp_path / name).write_bytes(body)
    with ranges_of(spark, size):
        lines = read_log_lines(spark, str(tmp_path))
        found = {}
        for r in lines.orderBy("line_no").collect():
            found.setdefault(r.file.rsplit("/", 1)[1], []).append((r.line_no, r.line))
        assert lines.rdd.getNumPartitions() > 20 or size > 7
        errors = {k.rsplit("/", 1)[1]: v for k, v in digests(stages.run_log_digest(spark, str(tmp_path))).items()}
    want = {name: plain_lines(body) for name, body in data.items()}
    assert found == {name: list(enumerate(lines)) for name, lines in want.items() if lines}
    assert errors == {name: sorted(expected(lines)) for name, lines in want.items() if lines}


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    with open(tmp_path / "hot.log", "w") as f:
        f.writelines(f"! error {i}\n" if i % 50_000 == 49_999 else f"line {i}\n" for i in range(300_000))
    (tmp_path / "calm.log").write_text("a\nb")
    with ranges_of(spark, 100_000):
        lines = read_log_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 30
        assert lines.where("line != concat(if(line like '!%', '! error ', 'line '), line_no) and file like '%hot.log'").count() == 0
        found = stages.run_log_digest(spark, str(tmp_path))
        rows = sorted((r.line_no, r.kind, r.line, r.context) for r in found.where("file like '%hot.log'").collect())
        assert found.where("file like '%calm.log' and kind = 'tail'").count() == 2
    assert rows == [(n, "error", f"! error {n}", f"line {n + 1}" if n + 1 < 300_000 else None) for n in range(49_999, 300_000, 50_000)]


def test_lines_are_joined_to_ranges_by_broadcast(spark, tmp_path):
    """No text is shuffled to be numbered: the table of ranges is small and its size known."""
    (tmp_path / "a.log").write_text("x\n" * 50_000)
    with ranges_of(spark, 5_000):
        plan = read_log_lines(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_parts_of_a_log(spark, tmp_path):
    """The files of a folder, cut anywhere between lines, are one log in the order of their names."""
    draw = random.Random(3)
    logs = {f"log{i}": [draw.choice(["ok", "! e", "", "long " * 5]) if i else "fine" for _ in range(60)] for i in range(4)}
    for name, lines in logs.items():
        (tmp_path / name).mkdir()
        edges = [0, *sorted(draw.sample(range(1, 60), 5)), 60]
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            (tmp_path / name / f"part-{k}.log").write_text("".join(f"{x}\n" for x in lines[a:b]))
    with ranges_of(spark, 40):
        got = {k.rsplit("/", 1)[1]: v for k, v in digests(stages.run_log_digest(spark, str(tmp_path), parts=True)).items()}
    assert got == {name: sorted(expected(lines)) for name, lines in logs.items()}


def test_no_task_sorts_a_whole_log(spark, tmp_path, monkeypatch):
    """Logs are written in ranges of their lines, and numbered and digested as if each were one file."""
    monkeypatch.setattr(catalog_logs, "_PART_LINES", 100, raising=False)
    rows = [(i * 7 % 900, i % 4, i % 31, i % 11 if i % 9 else 4, float(i % 51), float(i)) for i in range(2_000)]
    spark.createDataFrame(rows, ", ".join(f"{c} {'double' if k > 3 else 'long'}" for k, c in enumerate(catalog_logs._ORDER))).write.parquet(f"{tmp_path}/lineitem.parquet")
    want = {f: [] for f in range(3)}
    for r in sorted(rows):
        want[r[3] % 3].append("! " * (r[4] >= 49 and r[3] % 3 != 2) + " ".join(str(int(x)) for x in r))
    path = catalog_logs.written_logs(spark, str(tmp_path))
    sizes = [r["count"] for r in spark.read.text(path, pathGlobFilter="*.txt").groupBy("file", F.col("_metadata.file_path")).count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 300 and sum(sizes) == len(rows)
    assert digests(catalog_logs.ranges_digest(spark, str(tmp_path))) == {f: expected(lines) for f, lines in want.items()}
    counted = catalog_logs.ranges_lines(spark, str(tmp_path)).collect()
    assert {r.file: (r.n, r["last"], r.digest) for r in counted} == {
        f: (len(x), len(x) - 1, sum(i * len(line) for i, line in enumerate(x))) for f, x in want.items()
    }


def outline_of(rows, sizes, tail):
    """What ``_outlines`` makes of (file, range, line) rows that come in batches of so many."""
    schema = pa.schema([("file", pa.string()), ("range", pa.int64()), ("line", pa.string()), ("place", pa.int64())])
    batches, at = [], 0
    for size in sizes:
        part = [(*r, at + i) for i, r in enumerate(rows[at : at + size])]
        batches.append(pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in part], schema=schema))
        at += size
    return [tuple(r.values()) for b in _outlines(iter(batches), "!", tail) for r in b.to_pylist()]


def test_outlines_of_ranges_in_batches():
    """Ranges and files that end anywhere in a batch, batches of a row and of none, errors in every place."""
    draw = random.Random(4)
    for case in range(400):
        tail, rows, want = draw.choice([1, 2, 10]), [], []
        for file in "ab"[: draw.randrange(3)]:
            for start in range(draw.randrange(1, 5)):
                lines = [draw.choice(["ok", "!", "! e", "", "é"] if case % 3 else ["ok"]) for _ in range(draw.randrange(1, 14))]
                first, last = len(rows), len(rows) + len(lines) - 1
                want += [(file, start, first, "first", lines[0], None), (file, start, last, "last", None, None)]
                hits = [(file, start, first + i, "error", x, (lines + [None])[i + 1]) for i, x in enumerate(lines) if x.startswith("!")]
                ends = [(file, start, first + i, "tail", x, None) for i, x in enumerate(lines) if i >= len(lines) - tail]
                want += hits or ends
                rows += [(file, start, x) for x in lines]
        sizes = []
        while sum(sizes) < len(rows):
            sizes.append(min(draw.randrange(6) if case % 2 else draw.randrange(40), len(rows) - sum(sizes)))
        assert sorted(outline_of(rows, sizes, tail), key=repr) == sorted(want, key=repr)


def test_small_ranges_are_read_by_few_tasks(spark, tmp_path):
    """Thousands of ranges: what takes time is the task, so one reads many of them, in order."""
    lines = ["! e" if i % 40 == 7 else f"line {i}" for i in range(20_000)]
    (tmp_path / "a.log").write_text("".join(f"{x}\n" for x in lines))
    with ranges_of(spark, 100):
        numbered = read_log_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 1_500
        assert 32 <= numbered.rdd.getNumPartitions() <= 200
        assert [(r.line_no, r.line) for r in numbered.orderBy("line_no").collect()] == list(enumerate(lines))


def test_text_is_read_once_and_not_joined(spark, tmp_path, monkeypatch):
    """Every other line an error, no table broadcast: a line finds the next one where it is read."""
    lines = [f"! e {i}" if i % 2 else f"line {i}" for i in range(5_000)]
    (tmp_path / "a.log").write_text("\n".join(lines))
    (tmp_path / "b.log").write_text("\n".join(f"calm {i}" for i in range(5_000)))
    plans = []

    def seen(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df)

    monkeypatch.setattr("winnow.sources.logs.stored", seen)
    monkeypatch.setattr("winnow.operators.logdigest.stored", seen)
    monkeypatch.setattr(catalog_logs, "_RANGE_BYTES", 5_000)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = catalog_logs._in_ranges(spark, lambda: stages.run_log_digest(spark, str(tmp_path)))
        got = {k.rsplit("/", 1)[1]: v for k, v in digests(found).items()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plans.append(found._jdf.queryExecution().optimizedPlan().toString())
    reading = [p for p in plans if " text" in p]
    assert len(reading) == 1 and "Join" not in reading[0]
    assert got == {"a.log": sorted(expected(lines)), "b.log": [(i, "tail", f"calm {i}", None) for i in range(4_990, 5_000)]}
