"""Document sinks as a data source: batch, stream, failures and replays."""

import json
import shutil

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docweave.operators import assemble as A
from docweave.operators import sinks as K

PAGES = [(f"https://{'hot' if i % 3 else f'd{i % 5}'}.test/p{i}", f"text {i} ü" * (i % 4 + 1)) for i in range(60)]
FOLDER, DOMAIN = "folder_per_domain", "file_per_domain"


@pytest.fixture
def known(spark):
    spark.dataSource.register(K.DocumentSource)
    return spark


def saves(spark, pages):
    rows = [(u, t, i) for i, (u, t) in enumerate(pages)]
    return A.saves(spark.createDataFrame(rows, "url string, content string, ord long").repartition(5))


def found(path):
    return {str(f.relative_to(path)): f.read_text() for f in path.rglob("*.md") if "_staging" not in f.parts}


def wanted(pages, strategy):
    out = {}
    for url, text in pages:
        host, name = url.removeprefix("https://").split("/")
        if strategy == FOLDER:
            out[f"{host}/{name}.md"] = text
        else:
            out[f"{host}.md"] = (out[f"{host}.md"] + "\n\n---\n\n" if f"{host}.md" in out else "") + f"# {url}\n\n{text}"
    return out


@pytest.mark.parametrize("strategy", [FOLDER, DOMAIN])
def test_batch_writes_once_and_lists_its_documents(known, tmp_path, strategy):
    out = tmp_path / "store"
    m = A.write_documents(saves(known, PAGES), str(out), strategy)
    assert found(out) == wanted(PAGES, strategy)
    stamp = {f: f.stat().st_mtime_ns for f in out.rglob("*.md")}
    assert m.count() and m.agg(F.sum("size")).first()[0] == sum(len(t) for _, t in PAGES)
    assert {f: f.stat().st_mtime_ns for f in out.rglob("*.md")} == stamp  # a second action writes nothing
    assert not any((out / "_staging").iterdir())
    # a later run replaces what it names; overwrite removes the rest
    A.write_documents(saves(known, PAGES[:7]), str(out), strategy)
    assert found(out) == wanted(PAGES, strategy) | wanted(PAGES[:7], strategy)
    A.write_documents(saves(known, PAGES[:7]), str(out), strategy, mode="overwrite")
    assert found(out) == wanted(PAGES[:7], strategy)


def test_one_domain_is_written_by_several_tasks(known, tmp_path):
    out = tmp_path / "store"
    pages = [(f"https://one.test/{i}", "ü" * (i + 1)) for i in range(50)]
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    known.conf.set(merge, "false")  # else so little is one partition
    m = A.write_domain_documents(A.domain_blocks(saves(known, pages)), str(out), part_pages=5)
    known.conf.unset(merge)
    assert found(out) == wanted(pages, DOMAIN)
    assert m.count() > 1 and m.agg(F.sum("pages")).first()[0] == 50


def test_a_store_without_offsets_gets_the_same_documents(known, tmp_path, monkeypatch):
    monkeypatch.setattr(K, "can_place", lambda path: False)
    out = tmp_path / "store"
    for pages in (PAGES, PAGES[:9]):
        A.write_documents(saves(known, pages), str(out), DOMAIN)
    assert found(out) == wanted(PAGES, DOMAIN) | wanted(PAGES[:9], DOMAIN)


@pytest.mark.parametrize("strategy", [FOLDER, DOMAIN])
def test_aborted_job_leaves_the_documents_as_they_were(known, tmp_path, strategy):
    out = tmp_path / "store"
    A.write_documents(saves(known, PAGES[:20]), str(out), strategy)
    bad = saves(known, PAGES).withColumn("content", F.when(F.col("ord") == 41, F.raise_error(F.lit("lost"))).otherwise(F.concat("content", F.lit("!"))))
    with pytest.raises(Exception, match="lost"):
        A.write_documents(bad, str(out), strategy)
    assert found(out) == wanted(PAGES[:20], strategy)
    assert not any((out / "_staging").iterdir()) and len(list((out / "_commits").glob("*.json"))) == 1


def batches(rows, schema):
    return iter([pa.RecordBatch.from_pylist(rows[i:i + 2], schema=schema) for i in range(0, len(rows), 2)])


def lost(rows, schema):
    yield from batches(rows[:3], schema)
    raise RuntimeError("executor lost")


FILE_ROWS = pa.schema([("rel", pa.string()), ("content", pa.string()), ("url", pa.string()), ("size", pa.int64())])
PLACED_ROWS = pa.schema([("domain", pa.string()), ("offset", pa.int64()), ("block", pa.string()), ("url", pa.string()), ("size", pa.int64())])
PAGE_ROWS = pa.schema([("domain", pa.string()), ("url", pa.string()), ("content", pa.string()), ("size", pa.int64())])
CASES = [
    (FOLDER, FILE_ROWS, [{"rel": f"d/{i % 4}.md", "content": f"v{i}", "url": "u", "size": 2} for i in range(7)],
     {"d/0.md": "v4", "d/1.md": "v5", "d/2.md": "v6", "d/3.md": "v3"}),
    (DOMAIN, PLACED_ROWS, [{"domain": "d", "offset": 2 * i, "block": f"b{i}", "url": "u", "size": 2} for i in (3, 0, 1, 4, 2)], {"d.md": "b0b1b2b3b4"}),
    (DOMAIN, PAGE_ROWS, [{"domain": f"d{i % 2}", "url": "u", "content": f"c{i}", "size": 2} for i in range(4)],
     {"d0.md": "# u\n\nc0\n\n---\n\n# u\n\nc2", "d1.md": "# u\n\nc1\n\n---\n\n# u\n\nc3"}),
]


def writer(kind, schema, path, strategy):
    return kind({"path": str(path), "strategy": strategy}, StructType.fromJson({"fields": [
        {"name": n, "type": "string", "nullable": True, "metadata": {}} for n in schema.names], "type": "struct"}), False)


@pytest.mark.parametrize("strategy, schema, rows, documents", CASES)
def test_killed_task_is_written_again(tmp_path, strategy, schema, rows, documents):
    w = writer(K.DocumentWriter, schema, tmp_path, strategy)
    with pytest.raises(RuntimeError):
        w.write(lost(rows, schema))
    w.commit([w.write(batches(rows, schema)), None])
    assert found(tmp_path) == documents


@pytest.mark.parametrize("moved", [0, 1, 2])
@pytest.mark.parametrize("strategy, schema, rows, documents", CASES)
def test_commit_that_was_cut_off_is_carried_on(tmp_path, monkeypatch, strategy, schema, rows, documents, moved):
    first = writer(K.DocumentStreamWriter, schema, tmp_path, strategy)
    step = "append_parts" if schema is PAGE_ROWS else "move"
    whole, calls = getattr(K.Layout, step), []

    def cut(self, *a):
        calls.append(a)
        if len(calls) > moved:
            raise OSError("driver lost")
        return whole(self, *a)

    with monkeypatch.context() as m:
        m.setattr(K.Layout, step, cut)
        m.setattr(K, "MOVERS", 1)
        try:
            first.commit([first.write(batches(rows, schema))], 0)
        except OSError:
            pass
    second = writer(K.DocumentStreamWriter, schema, tmp_path, strategy)  # the batch is replayed
    second.commit([second.write(batches(rows, schema))], 0)
    assert found(tmp_path) == documents
    third = writer(K.DocumentStreamWriter, schema, tmp_path, strategy)  # and once more, after its mark
    third.commit([third.write(batches(rows, schema))], 0)
    assert found(tmp_path) == documents and not any((tmp_path / "_staging").iterdir())


def test_recover_finishes_a_commit_or_leaves_nothing(tmp_path, monkeypatch):
    strategy, schema, rows, documents = CASES[0]
    w = writer(K.DocumentWriter, schema, tmp_path, strategy)
    message = w.write(batches(rows, schema))
    assert K.recover(str(tmp_path)) == 0 and found(tmp_path) == {}  # staged only: never there
    with monkeypatch.context() as m:
        m.setattr(K.Layout, "publish", lambda *a: (_ for _ in ()).throw(OSError("driver lost")))
        with pytest.raises(OSError):
            w.commit([message])
    assert K.recover(str(tmp_path)) == 1 and found(tmp_path) == documents and K.recover(str(tmp_path)) == 0


def test_unfit_rows_and_strategies_are_refused(known, tmp_path):
    df = known.createDataFrame([("a", "b")], "rel string, content string")
    for strategy in (FOLDER, DOMAIN, "zip"):
        with pytest.raises(Exception):
            df.write.format(K.FORMAT).options(path=str(tmp_path), strategy=strategy).mode("append").save()
    with pytest.raises(ValueError):
        K.check_strategy("zip")


@pytest.mark.parametrize("strategy", [FOLDER, DOMAIN])
def test_stream_and_replayed_batch_leave_one_set(known, tmp_path, strategy):
    source, out, ckpt = (tmp_path / n for n in ("in", "out", "ckpt"))
    schema = "url string, content string, ord long"

    def arrive(n, lo, hi):
        known.createDataFrame([(u, t, i) for i, (u, t) in enumerate(PAGES)][lo:hi], schema).coalesce(1).write.parquet(str(source / f"part={n}"))

    def drain():
        s = known.readStream.schema(schema).parquet(str(source / "part=*"))
        q = A.stream_rows(A.saves(s), strategy).writeStream.format(K.FORMAT).options(path=str(out), strategy=strategy)
        q.option("checkpointLocation", str(ckpt)).trigger(availableNow=True).start().awaitTermination()

    arrive(0, 0, 25)
    drain()
    assert found(out) == wanted(PAGES[:25], strategy)
    arrive(1, 25, 60)
    drain()
    assert found(out) == wanted(PAGES, strategy)
    last = max(int(f.name) for f in (ckpt / "commits").iterdir() if f.name.isdigit())
    for f in (ckpt / "commits").iterdir():  # the engine forgets that the last batch was committed
        if f.name.strip(".").startswith(str(last)):
            f.unlink()
    drain()
    assert found(out) == wanted(PAGES, strategy)
    m = K.manifest(known, str(out))
    assert m.agg(F.sum("pages")).first()[0] == len(PAGES) and m.select("commit").distinct().count() == 2
    plan = json.loads(next((out / "_commits").glob("*.json")).read_text())
    assert plan["id"].startswith("batch-")
    shutil.rmtree(source)
