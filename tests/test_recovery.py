"""State that follows from result files, and downloads that appear whole or not at all."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from loomspan.sources import download as D
from loomspan.streaming import recovery as R
from loomspan.streaming.resume import upsert_stream

ID = ["pdf_sha256"]


def _write(folder, name, **fields):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as file:
        json.dump(fields, file, ensure_ascii=False)


@pytest.fixture()
def results(tmp_path):
    folder = str(tmp_path / "results")
    _write(folder, "a.json", url="a", status="succeeded", parser_version="2", pdf_sha256="x", stats={"rows": 2, "tables": 1}, rows=[{"item": "甲"}, {"item": "乙"}])
    _write(folder, "b.json", url="b", status="partial", parser_version="2", pdf_sha256="y", stats={"rows": 1}, rows=[{"item": "丙"}])
    _write(folder, "c.json", url="c", status="retryable_failed", parser_version="2", pdf_sha256="z", stats={}, rows=[{"item": "不"}])
    _write(folder, "d.json", url="d", status="succeeded", parser_version="1", pdf_sha256="w", stats={"rows": 9}, rows=[{"item": "旧"}])
    _write(folder, "e.json", url="", status="succeeded", parser_version="2", rows=[])
    _write(folder, "g.json", url="g", parser_version="2", rows=None)
    with open(os.path.join(folder, "f.json"), "w") as file:
        file.write('{"url": "f", "rows": [{"ite')  # the run was cut off while it wrote
    return folder


def test_state_after_a_run_that_was_cut_off(spark, results):
    """Files are written before the state is: b is done but not in the state, a is there with an older one, x has no file."""
    files = R.result_files(spark, results, "item string", ID)
    state = spark.createDataFrame([("a", "retryable_failed", "1", "", 3, "note"), ("x", "succeeded", "2", "q", 1, None), ("d", "succeeded", "1", "w", 2, None)], "url string, status string, parser_version string, pdf_sha256 string, attempts int, note string")
    once = R.recovered_state(state, files, "2", ID)
    want = {("a", "succeeded", "2", "x", 3, "note"), ("b", "partial", "2", "y", 1, None), ("c", "retryable_failed", "2", "z", 1, None), ("g", "retryable_failed", "2", "", 1, None), ("x", "succeeded", "2", "q", 1, None), ("d", "succeeded", "1", "w", 2, None)}
    assert set(map(tuple, once.collect())) == want
    assert set(map(tuple, R.recovered_state(once, files, "2", ID).collect())) == want  # again, and nothing changes
    assert {os.path.basename(r.file) for r in R.unreadable(files).collect()} == {"e.json", "f.json"}
    assert sorted((r.result_url, r.at, r.item) for r in R.rebuilt_rows(files, "2").collect()) == [("a", 0, "甲"), ("a", 1, "乙"), ("b", 0, "丙")]
    assert {r["name"]: r["n"] for r in R.result_stats(files, "2").collect()} == {"rows": 3, "tables": 1}


def test_later_files_and_no_files(spark, results, tmp_path):
    _write(results, "a2.json", url="a", status="partial", parser_version="2", pdf_sha256="x", rows=[{"item": "新"}])
    os.utime(os.path.join(results, "a.json"), (1e9, 1e9))
    files = R.result_files(spark, results, "item string", ID)
    assert [r.item for r in R.rebuilt_rows(files, "2").filter("result_url = 'a'").collect()] == ["新"]
    none = R.result_files(spark, str(tmp_path / "absent"), "item string", ID)
    assert none.count() == 0 and R.rebuilt_rows(none, "2").count() == 0
    legacy = R.legacy_state(spark.createDataFrame([("a",), ("a",)], "url string"), ID).collect()
    assert [tuple(r) for r in legacy] == [("a", "succeeded", "", "", 1)]


def test_better_results_stay(spark):
    kind = "url string, status string, parser_version string, pdf_sha256 string, n_rows int"
    before = spark.createDataFrame([("a", "succeeded", "2", "x", 1), ("b", "partial", "2", "x", 9), ("c", "succeeded", "1", "x", 9), ("d", "succeeded", "2", "old", 9)], kind)
    after = spark.createDataFrame([(u, "partial", "2", "x", 5) for u in "abcd"], kind)
    assert {r.url: (r.status, r.n_rows) for r in R.saved(before, after, "2", ID).collect()} == {"a": ("succeeded", 1), "b": ("partial", 9), "c": ("partial", 5), "d": ("partial", 5)}


def test_a_success_beats_more_rows_in_one_batch(spark, tmp_path):
    """The stream form on a batch that holds both attempts of a link."""
    kind = "url string, status string, pdf_sha256 string, n_rows int"
    source, table = str(tmp_path / "in"), {}
    spark.createDataFrame([("a", "succeeded", "x", 5), ("a", "partial", "x", 9), ("b", "partial", "x", 2), ("b", "partial", "x", 3)], kind).coalesce(1).write.parquet(source)
    empty = spark.createDataFrame([], kind)
    stream = spark.readStream.schema(kind).parquet(source)
    query = upsert_stream(stream, "url", ID, lambda: spark.createDataFrame(list(table.values()), kind) if table else empty, lambda df: table.update({r.url: tuple(r) for r in df.collect()}), str(tmp_path / "cp"))
    running = query.trigger(availableNow=True).start()
    assert running.awaitTermination(120)
    assert table == {"a": ("a", "succeeded", "x", 5), "b": ("b", "partial", "x", 3)}


PAGE = b"%PDF-1.4\n" + b"x" * 4000


def _opener(tries=None):
    """Answers by the address; closures travel to the workers by value."""

    def answer(url, timeout):
        import io

        class Answer:
            headers, code, final = {}, 200, "https://h/final.pdf"

            def __init__(self):
                name = url.rsplit("/", 1)[-1]
                body = b"%PDF-1.4\n" + b"x" * 4000
                self.stream, self.broken = io.BytesIO(body), False
                if name == "page.pdf":
                    self.stream = io.BytesIO(b"not a pdf" * 300)
                elif name == "small.pdf":
                    self.stream = io.BytesIO(b"%PDF-1.4")
                elif name == "large.pdf":
                    self.headers = {"Content-Length": "999999"}
                elif name == "endless.pdf":
                    self.stream = io.BytesIO(body * 100)
                elif name == "broken.pdf":
                    self.broken = True
                elif name == "moved.pdf":
                    self.final = "file:///etc/passwd"
                elif name == "gone.pdf":
                    self.code = 404
                else:
                    self.headers = {"ETag": "e1", "Last-Modified": "then"}

            def __enter__(self):
                return self

            def __exit__(self, *_):
                return False

            def getcode(self):
                return self.code

            def geturl(self):
                return self.final

            def read(self, size):
                if self.broken and self.stream.tell():
                    raise ConnectionError("download interrupted")
                return self.stream.read(min(size, 64))

        if url.endswith("tls.pdf"):
            raise OSError("certificate verify failed")
        if tries is not None:
            tries.append(url)
        return Answer()

    return answer


def test_downloads_are_bounded_and_checked(spark, tmp_path):
    folder = str(tmp_path / "pdfs")
    bad = {"page": "does not start", "small": "too small", "large": "size limit", "endless": "size limit", "broken": "interrupted", "moved": "only absolute", "gone": "404", "tls": "certificate verify failed"}
    urls = ["https://h/a b.pdf", "https://h/a b.pdf", "ftp://h/x.pdf", "file:///tmp/a.pdf", None, *[f"https://h/{n}.pdf" for n in bad]]
    got = {r.url: r for r in D.download(spark.createDataFrame([(u,) for u in urls], "url string"), folder, opener=_opener(), most_bytes="50000").collect()}
    assert len(got) == len(set(urls) - {None})
    ok = got["https://h/a b.pdf"]
    assert (ok.status, ok.bytes, ok.sha256, ok.etag, ok.final_url) == ("downloaded", len(PAGE), hashlib.sha256(PAGE).hexdigest(), "e1", "https://h/final.pdf")
    with open(ok.path, "rb") as file:
        assert file.read() == PAGE
    for name, said in bad.items():
        r = got[f"https://h/{name}.pdf"]
        assert r.status == "failed" and said in r.error and r.path == "" and r.bytes == 0, r
    assert got["ftp://h/x.pdf"].error.startswith("ValueError") and got["file:///tmp/a.pdf"].status == "failed"
    assert len([f for _, _, fs in os.walk(folder) for f in fs if f.endswith(".pdf")]) == 1 and not os.listdir(os.path.join(folder, "_staging"))


def test_earlier_files_are_used_again(spark, tmp_path):
    folder = str(tmp_path / "pdfs")
    links = spark.createDataFrame([("https://h/a.pdf",), ("https://h/b.pdf",)], "url string")
    first = D.download(links, folder, opener=_opener())
    paths = {r.url: r.path for r in first.collect()}
    with open(paths["https://h/b.pdf"], "wb") as file:
        file.write(b"%PDF-1.4 changed" * 200)  # other bytes than the manifest says
    held = spark.createDataFrame(first.collect(), D.MANIFEST)
    again = {r.url: r for r in D.download(links, folder, held, opener=_opener(), batch="two").collect()}
    assert {u: r.status for u, r in again.items()} == {"https://h/a.pdf": "cached", "https://h/b.pdf": "downloaded"}
    assert {r.sha256 for r in again.values()} == {hashlib.sha256(PAGE).hexdigest()}
    failing = D.download(links, folder, opener=lambda url, timeout: (_ for _ in ()).throw(OSError("down")))
    assert {r.status for r in failing.collect()} == {"cached", "downloaded"}  # a later failure hides nothing


def test_batches_appear_whole_or_not_at_all(tmp_path):
    folder = str(tmp_path / "pdfs")
    writer = D.download_source(_opener())({"path": folder, "batch": "one"}).writer(None, False)
    row = {"url": "https://h/a.pdf", "old_path": "", "old_sha256": "", "old_final_url": ""}
    lost, kept = writer.write(iter([row])), writer.write(iter([row]))
    assert not os.path.exists(os.path.join(folder, "batch=one"))
    writer.commit([kept, None])
    assert os.listdir(os.path.join(folder, "batch=one")) == [os.path.basename(kept.folder)] and lost.links == 1
    with pytest.raises(FileExistsError):
        writer.commit([kept])
    other = D.download_source(_opener())({"path": folder, "batch": "two"}).writer(None, False)
    other.write(iter([row]))
    other.abort([])
    assert sorted(os.listdir(folder)) == ["_staging", "batch=one"] and not os.listdir(os.path.join(folder, "_staging"))


def test_tries(tmp_path):
    tries = []
    entry = D.obtained("https://h/broken.pdf", str(tmp_path / "x.pdf"), ("", "", ""), _opener(tries))
    assert entry["status"] == "failed" and len(tries) == D.TRIES and not os.path.exists(tmp_path / "x.pdf")
    assert D.checked_url("https://h/a b.pdf?q=1 2") == "https://h/a%20b.pdf?q=1%202"


def test_state_column_order(spark):
    state = spark.createDataFrame([], "note string, url string, status string, parser_version string, pdf_sha256 string")
    files = spark.createDataFrame([("a", "succeeded", "2", "x", None, None, 0, "f", None, None)], "url string, status string, parser_version string, pdf_sha256 string, stats map<string,long>, rows array<struct<item:string>>, n_rows int, file string, modified timestamp, corrupt string")
    assert [tuple(r) for r in R.recovered_state(state, files, "2", ID).select(F.expr("*")).collect()] == [(None, "a", "succeeded", "2", "x")]
