from docstrata.sources import manifests
from docstrata.sources.fetch import Fetcher, Policy, Reply, decoded, fetched


def policy(log, **more):
    now = [0.0]

    def sleep(seconds):
        log.append(round(seconds, 3))
        now[0] += seconds

    return Policy(sleep=sleep, clock=lambda: now[0], jitter=lambda: 1.0, **more)


def test_retries_wait_and_give_up():
    replies, log = [Reply(503), Reply(429, headers={"retry-after": "99"}), Reply(200, b"ok")], []
    assert Fetcher(lambda u: replies.pop(0), policy(log)).fetch("u") == (b"ok", None, None, 3) and log == [2.0, 30.0]
    log = []
    assert Fetcher(lambda u: Reply(500), policy(log, attempts=6, longest=10)).fetch("u") == (None, None, "HTTP 500", 6) and log == [2.0, 4.0, 8.0, 10, 10]
    log = []
    assert Fetcher(lambda u: Reply(404), policy(log)).fetch("u") == (None, None, "HTTP 404", 1) and log == []
    assert Fetcher(lambda u: Reply(200, b"123456"), policy(log, most_bytes=5)).fetch("u")[2] == "body over the size limit"


def test_requests_keep_their_distance():
    log = []
    f = Fetcher(lambda u: Reply(200), policy(log, spacing=0.5))
    for _ in range(3):
        f.fetch("u")
    assert log == [0.5, 0.5]


def test_decoding():
    assert decoded("\ufeffé".encode(), None) == "é" and decoded("é".encode("latin-1"), "text/html; charset=latin-1") == "é"
    assert decoded(b"\xff", "text/html; charset=none-such") == "\ufffd" and decoded(b"\xff", None) == "\ufffd"


def test_failures_stay_with_their_rows(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "url string, error int")
    connect = lambda: lambda u: Reply(200, b"x") if u == "a" else Reply(410)
    assert rows(fetched(df, "url", connect, Policy(delay=0.0)), "url", "text", "error", "attempts") == sorted([("a", "x", None, 1), ("b", None, "HTTP 410", 1), (None, None, "no address", 0)], key=repr)
    assert fetched(df.where("false"), "url", connect).count() == 0


def test_page_export(spark, tmp_path, rows):
    pages = lambda *r: spark.createDataFrame(list(r), "slug string, text string, is_written boolean")
    gone = lambda *s: spark.createDataFrame([(x,) for x in s], "slug string")
    manifests.write_pages(pages(("a/b/c", "1", True), ("d", "2", True), ("../out", "x", True)), gone(), str(tmp_path / "docs"))
    assert (tmp_path / "docs/a/b/c.md").read_text() == "1" and not (tmp_path / "out.md").exists()
    (tmp_path / "docs/d.md").unlink()
    done = manifests.write_pages(pages(("d", "2", False), ("e", "3", True)), gone("a/b/c", "never", "e"), f"file://{tmp_path}/docs")
    assert rows(done) == [("a/b/c", "deleted"), ("d", "restored"), ("e", "written"), ("never", "absent")]
    assert manifests.prune_empty(str(tmp_path / "docs")) == ["a/b", "a"] and (tmp_path / "docs/d.md").read_text() == "2"
    again = manifests.write_pages(pages(("d", "2", False)), gone(), str(tmp_path / "docs"))
    assert rows(again) == [("d", "kept")]
