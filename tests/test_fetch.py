"""Transports, the fan-out over executors, and responses."""

import io
import json
import os
import sys
import threading
import time
import uuid
from contextlib import contextmanager
from http.client import RemoteDisconnected
from pathlib import Path
from types import SimpleNamespace
from urllib.error import HTTPError, URLError

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from hazeline import plans
from hazeline.operators import (
    build_requests,
    entries_or_reasons,
    explode_responses,
    parse_entries,
    repeat_entries,
    response_rejects,
)
from hazeline.plans.extract import fetch, settled
from hazeline.schemas import CORRUPT, FORECAST, OBSERVATION
from hazeline.sinks import write_table
from hazeline.sources import (
    HttpTransport,
    Reply,
    fetch_responses,
    scan_json_lines,
    scan_table,
)
from hazeline.sources.web import Pace

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LOCATION = "`TWC code` string, Latitude float, Longitude float"
KEY = "s3cret/key"


class Response(io.BytesIO):
    status = 200


class Opener:
    """Stands in for ``urlopen``: plays back outcomes and records what was asked."""

    def __init__(self, *outcomes):
        self.outcomes = list(outcomes)
        self.urls = []

    def __call__(self, url, timeout):
        self.urls.append(url)
        outcome = self.outcomes.pop(0)
        if isinstance(outcome, Exception):
            raise outcome
        return Response(outcome)


def clock(monkeypatch, sleep, monotonic=time.monotonic):
    """Another clock for the calls alone; other threads go on by the real one."""
    monkeypatch.setattr("hazeline.sources.web.time", SimpleNamespace(sleep=sleep, monotonic=monotonic))


def http_error(code):
    return HTTPError("https://x/?API_KEY=" + KEY, code, "message", {}, None)


def call(*outcomes, **options):
    opener = Opener(*outcomes)
    transport = HttpTransport("https://api.example/", KEY, backoff=0, opener=opener, **options)
    return transport("aq/?a=1"), opener


def test_http_success():
    reply, opener = call("[é]".encode())
    assert reply == Reply(200, "[é]", None)
    assert opener.urls == ["https://api.example/aq/?a=1&API_KEY=s3cret%2Fkey"]


def test_http_retries_transient_failures_only():
    reply, opener = call(http_error(503), URLError("down"), http_error(429), b"[]")
    assert reply == Reply(200, "[]", None) and len(opener.urls) == 4
    reply, opener = call(http_error(404))
    assert reply == Reply(404, None, "HTTP 404") and len(opener.urls) == 1
    reply, opener = call(*[TimeoutError("slow")] * 2, attempts=2)
    assert reply == Reply(None, None, "TimeoutError: slow") and len(opener.urls) == 2


def test_http_body_that_is_not_utf8():
    reply, _ = call(b"\xff\xfe")
    assert reply.body is None and reply.error == "body is not UTF-8"


def test_api_key_stays_out_of_sight():
    reply, _ = call(*[URLError(f"bad {KEY} s3cret%2Fkey")] * 4)
    assert "s3cret" not in reply.error
    assert "s3cret" not in repr(HttpTransport("https://api.example", KEY))


def test_http_needs_an_attempt():
    with pytest.raises(ValueError):
        HttpTransport("https://api.example", attempts=0)


class Canned:
    """Replies by the latitude in the URL, and leaves a file for every call."""

    def __init__(self, folder, replies):
        self.folder = str(folder)
        self.replies = replies

    def __call__(self, url):
        Path(self.folder, uuid.uuid4().hex).write_text(url)
        reply = self.replies[url.split("latitude=")[1].split("&")[0]]
        if isinstance(reply, Exception):
            raise reply
        return reply

    def calls(self):
        return sorted(p.read_text() for p in Path(self.folder).iterdir())


def entry(**fields):
    return {"ParameterName": "PM2.5", "AQI": 5, "Extra": [1], **fields}


def two(*names):
    return Reply(200, json.dumps([entry(ReportingArea=n) for n in names]), None)


REPLIES = {
    "1.0": two("a", "b"),
    "2.0": Reply(200, "[]", None),
    "3.0": Reply(200, "oops", None),
    "4.0": Reply(500, "[{}]", "HTTP 500"),
    "5.0": Reply(None, None, "TimeoutError: slow"),
    "6.0": RuntimeError("transport broke"),
    "7.0": Reply(200, json.dumps(entry(ReportingArea="object")), None),
    "8.0": Reply(200, None, None),
    "9.0": Reply(404, None, None),
    "10.0": Reply(200, '[{"ReportingArea": "line\\nbreak",\n "AQI": 1.50}]', None),
    "11.0": Reply(200, "[{}]", None),
}


@pytest.fixture
def canned(tmp_path):
    folder = tmp_path / "calls"
    folder.mkdir()
    return Canned(folder, REPLIES)


@pytest.fixture
def stations(spark, tmp_path):
    def write(*latitudes):
        path = str(tmp_path / "stations")
        rows = [(f"T{i}", latitude, 0.5) for i, latitude in enumerate(latitudes)]
        write_table(spark.createDataFrame(rows, LOCATION), path)
        return path

    return write


@pytest.fixture
def fetched(spark, tmp_path, canned, stations):
    def run(*latitudes):
        return fetch(
            spark, stations(*latitudes), str(tmp_path / "responses"), str(tmp_path / "rejects"),
            canned, "forecast", "2024-01-01", 3,
        )

    return run


def areas(entries):
    return sorted(r.ReportingArea for r in parse_entries(entries, FORECAST).collect())


def test_each_place_is_called_once(canned, fetched):
    replies = fetched(1.0, 1.0, 1.00001, 2.0)
    assert len(canned.calls()) == 2
    counts = {r.url.split("latitude=")[1][:3]: r.n_requests for r in replies.collect()}
    assert counts == {"1.0": 3, "2.0": 1}
    # ... and gives the rows that calling once per station would have given.
    assert areas(repeat_entries(explode_responses(replies))) == ["a"] * 3 + ["b"] * 3
    # Using the stored replies again calls nothing.
    replies.count()
    assert len(canned.calls()) == 2


def test_failures_do_not_stop_the_others(spark, tmp_path, fetched):
    replies = fetched(*map(float, range(1, 12)), None)
    entries = repeat_entries(explode_responses(replies))
    rows = parse_entries(entries, FORECAST).collect()
    assert sorted(str(r.ReportingArea) for r in rows) == ["None", "a", "b", "line\nbreak"]
    reasons = {
        r.url.split("latitude=")[1].split("&")[0]: r.reason
        for r in response_rejects(replies).collect()
    }
    assert reasons == {
        "3.0": "body is not a JSON array",
        "4.0": "HTTP 500",
        "5.0": "TimeoutError: slow",
        "6.0": "RuntimeError: transport broke",
        "7.0": "body is not a JSON array",
        "8.0": "no body",
        "9.0": "HTTP 404",
    }
    unusable = scan_table(spark, str(tmp_path / "rejects/coordinates")).collect()
    assert [r["TWC code"] for r in unusable] == ["T11"]


def test_every_reply_is_entries_or_reject(fetched):
    replies = fetched(*map(float, range(1, 12)))
    used = {r.url for r in explode_responses(replies).collect()}
    rejected = {r.url for r in response_rejects(replies).collect()}
    both = entries_or_reasons(replies).collect()
    assert {r.url for r in both if r.reason is None} == used
    assert {r.url for r in both if r.reason is not None} == rejected
    silent = {r.url for r in replies.collect()} - used - rejected
    assert not used & rejected
    assert [u.split("latitude=")[1][:3] for u in silent] == ["2.0"]  # the empty array


def test_no_usable_station(spark, tmp_path, canned, stations):
    path = {n: str(tmp_path / n) for n in ("responses", "table", "rejects")}
    plans.fetch_and_transform(
        spark, stations(None, None), path["responses"], path["table"], path["rejects"], canned,
        "forecast", "2024-01-01", FORECAST, 2, most_failed=1.0,
    )
    assert scan_table(spark, path["table"]).schema.names == FORECAST.names
    assert scan_table(spark, path["table"]).count() == 0
    assert scan_table(spark, f"{path['rejects']}/coordinates").count() == 2


class KillsItsWorker:
    """Ends the Python process in the middle of the first task that gets to a certain call."""

    def __init__(self, marker):
        self.marker = str(marker)

    def __call__(self, url):
        if url.endswith("=17") and not Path(self.marker).exists():
            Path(self.marker).touch()
            os._exit(1)
        return two(url)


def test_a_lost_worker_loses_no_reply(spark, tmp_path):
    requests = spark.range(300).select(
        F.concat(F.lit("i="), (F.col("id") % 100).cast("string")).alias("url")
    )
    transport = KillsItsWorker(tmp_path / "killed")
    path = str(tmp_path / "responses")
    write_table(fetch_responses(requests, transport, 8), path)
    assert (tmp_path / "killed").exists()
    replies = scan_table(spark, path)
    assert replies.count() == replies.select("url").distinct().count() == 100
    assert replies.filter("status = 200 and n_requests = 3").count() == 100


def test_calls_are_spread_over_tasks(spark, canned):
    requests = spark.range(40).select(
        F.concat(F.lit("latitude=2.0&i="), F.col("id").cast("string")).alias("url")
    )
    frame = fetch_responses(requests, canned, 4)
    assert frame.rdd.getNumPartitions() == 4
    with pytest.raises(ValueError):
        fetch_responses(requests, canned, 0)


def test_requests_are_counted_before_the_shuffle(spark, canned, plan):
    requests = spark.range(40).select(F.col("id").cast("string").alias("url"))
    text = plan(fetch_responses(requests, canned, 4))
    steps = text.split("(1)")[0]
    assert steps.index("MapInArrow") < steps.index("Exchange") < steps.index("HashAggregate")
    assert "partial_count(1)" in text


@pytest.mark.parametrize("in_place", [0, 1, 3, 14, 100])
@pytest.mark.parametrize("per_share", [1, 2, 7, 15, 100])
def test_repeated_entries_are_complete_at_any_limit(spark, in_place, per_share):
    counts = {"a": 1, "b": 2, "c": 3, "d": 14, "e": 15, "f": 16}
    entries = spark.createDataFrame(
        [(f"u{t}", n, t) for t, n in counts.items()], "url string, n_requests bigint, entry string"
    )
    repeated = repeat_entries(entries, in_place, per_share)
    assert repeated.columns == ["url", "entry"]  # all but the number
    assert {r.entry: r["count"] for r in repeated.groupBy("entry").count().collect()} == counts


@pytest.mark.parametrize("places, stations", [(1, 1_000_000), (1_000, 1_000)])
def test_shared_places_that_lie_together_are_spread(spark, places, stations):
    entries = spark.range(0, places + 100, 1, 1).select(
        F.col("id").cast("string").alias("url"),
        F.when(F.col("id") < places, stations).otherwise(1).cast("bigint").alias("n_requests"),
        F.lit("x").alias("entry"),
    )
    sizes = repeat_entries(entries).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(s["count"] for s in sizes) == 1_000_100
    assert max(s["count"] for s in sizes) < 200_000


def test_one_reply_for_a_million_stations_is_parsed_once(spark, plan):
    replies = spark.createDataFrame(
        [("u", 1_000_000, 200, json.dumps([entry(), entry(AQI=7)]), None)],
        "url string, n_requests bigint, status int, body string, error string",
    )
    parsed = parse_entries(explode_responses(replies), FORECAST, ("n_requests",))
    repeated = repeat_entries(parsed.drop(CORRUPT))
    assert repeated.groupBy("AQI").count().collect() == [(5.0, 1_000_000), (7.0, 1_000_000)]
    tree = repeated._jdf.queryExecution().optimizedPlan().toString()
    for line, parent in zip(tree.split("\n")[1:], tree.split("\n"), strict=False):
        # Nothing above the repetition parses; it is the generator over a sequence.
        assert not ("from_json" in parent and "explode(sequence(1, n_requests" in line)
    assert tree.index("explode(sequence(1, n_requests") < tree.index("from_json")


def test_rejects_parse_bodies_once(spark, fetched, plan):
    text = plan(response_rejects(fetched(1.0)))
    assert text.count("from_json(ArrayType(StringType,true), body#") == 1


class Slow:
    """A transport that waits, and tells which client of which process was asked."""

    def __init__(self, folder, wait=0.05):
        self.folder, self.wait = str(folder), wait

    @contextmanager
    def client(self):
        client = Slow(self.folder, self.wait)
        client.name = uuid.uuid4().hex
        yield client
        Path(self.folder, f"closed-{client.name}").touch()

    def __call__(self, url):
        Path(self.folder, f"{self.name}-{uuid.uuid4().hex}").write_text(url)
        time.sleep(self.wait)
        return Reply(503, None, "HTTP 503") if url.endswith("7") else Reply(200, f"[{url[2:]}]", None)


def test_concurrent_calls_and_one_client_per_task(spark, tmp_path):
    requests = spark.range(200).select(F.concat(F.lit("i="), F.col("id").cast("string")).alias("url"))
    seconds = {}
    for concurrency in (1, 10):
        folder = tmp_path / f"calls-{concurrency}"
        folder.mkdir()
        start = time.perf_counter()
        replies = fetch_responses(requests, Slow(folder), 2, concurrency).collect()
        seconds[concurrency] = time.perf_counter() - start
        files = [p for p in folder.iterdir() if not p.name.startswith("closed")]
        assert sorted(p.read_text() for p in files) == sorted(f"i={i}" for i in range(200))
        clients = {p.name.split("-")[0] for p in files}
        assert len(clients) == 2
        assert {p.name for p in folder.iterdir()} >= {f"closed-{name}" for name in clients}
        assert all(r.body == f"[{r.url[2:]}]" for r in replies if r.status == 200)
        assert sum(r.error == "HTTP 503" for r in replies) == 20
    assert seconds[10] < seconds[1] / 2


def test_retry_after_is_honoured(monkeypatch):
    waits = []
    clock(monkeypatch, waits.append)
    asked = HTTPError("https://x", 429, "message", {"Retry-After": "7"}, None)
    long = HTTPError("https://x", 503, "message", {"Retry-After": "9999"}, None)
    reply, _ = call(asked, long, http_error(503), b"[]")
    assert reply.status == 200 and waits == [7.0, 120.0, 0]


def test_what_cannot_change_is_not_tried_again(monkeypatch):
    clock(monkeypatch, lambda _: pytest.fail("waited"))
    with HttpTransport("ftp2://api.example").client() as client:
        assert "unknown" in client("x").error.lower()
    assert "unknown url type" in HttpTransport("ftp2://api.example")("x").error


def test_connections_are_kept_and_replaced(monkeypatch):
    """Without a network: a connection that answers twice, then has been closed by the server."""
    made = []

    class Connection:
        def __init__(self, netloc, timeout):
            made.append(self)
            self.left, self.open = 2, True

        def request(self, method, path, headers):
            if not self.left:
                raise RemoteDisconnected("closed")
            self.left -= 1
            self.path = path

        def getresponse(self):
            reply = Response(b"gone" if "missing" in self.path else self.path.encode())
            reply.status, reply.reason = (404 if "missing" in self.path else 200), ""
            reply.headers = {}
            return reply

        def close(self):
            self.open = False

    monkeypatch.setattr("hazeline.sources.web.HTTPSConnection", Connection)
    transport = HttpTransport("https://api.example/v1", KEY, backoff=0)
    with transport.client() as client:
        replies = [client(url) for url in ("aq?a=1", "aq?a=2", "aq?a=3", "missing?a=4")]
        assert [r.status for r in replies] == [200, 200, 200, 404] and len(made) == 2
        assert replies[0].body == "/v1/aq?a=1&API_KEY=s3cret%2Fkey"
    assert not any(connection.open for connection in made)


def test_bodies_are_parsed_once(spark, tmp_path, fetched, plan):
    entries = parse_entries(explode_responses(fetched(1.0)), FORECAST)
    text = plan(entries.filter("AQI > 1").select("ReportingArea"))
    assert text.count("from_json(ArrayType(StringType,true), body#") == 1
    assert "EqualNullSafe(status,200)" in text


@pytest.mark.parametrize("endpoint, schema", [("observation", OBSERVATION), ("forecast", FORECAST)])
def test_extract_and_fused_jobs_agree(spark, tmp_path, canned, stations, endpoint, schema):
    at = stations(1.0, 1.0, 10.0, 3.0)
    path = {n: str(tmp_path / n) for n in ("responses", "entries", "rejects", "table")}
    for _ in range(2):
        plans.extract(
            spark, at, path["responses"], path["entries"], path["rejects"], canned, endpoint,
            "2024-01-01", 3, most_failed=0.5,
        )
    lines = spark.read.text(path["entries"])
    assert lines.count() == 5
    assert lines.filter("value like '%Extra%'").count() == 4  # undeclared fields are kept
    plans.fetch_and_transform(
        spark, at, path["responses"], path["table"], path["rejects"], canned, endpoint,
        "2024-01-01", schema, 3, most_failed=0.5,
    )
    table = scan_table(spark, path["table"])
    assert table.columns == schema.names
    scanned = scan_json_lines(spark, path["entries"], schema).drop(CORRUPT)
    assert sorted(table.collect(), key=str) == sorted(scanned.collect(), key=str)


class Scripted:
    """Connections that play a service: what each path answers, and which were opened for what."""

    def __init__(self, answers):
        self.answers, self.asked, self.tunnels = answers, [], []

    def __call__(self, netloc, timeout):
        service = self

        class Connection:
            def request(self, method, path, headers):
                service.asked.append((netloc, path, headers))
                self.path = path

            def set_tunnel(self, host, headers):
                service.tunnels.append((netloc, host, headers))

            def getresponse(self):
                status, headers, body = service.answers[self.path]
                reply = Response(body)
                reply.status, reply.reason, reply.headers = status, "", headers
                return reply

            def close(self):
                pass

        return Connection()


@pytest.fixture
def service(monkeypatch):
    def play(answers, proxies=()):
        scripted = Scripted(answers)
        for kind in ("HTTPConnection", "HTTPSConnection"):
            monkeypatch.setattr(f"hazeline.sources.web.{kind}", scripted)
        monkeypatch.setattr("hazeline.sources.web.getproxies", lambda: dict(proxies))
        return scripted

    return play


def ask(url, base="https://api.example", **options):
    with HttpTransport(base, backoff=0, **options).client() as client:
        return client(url)


def test_redirects_are_followed(service):
    scripted = service({
        "/a": (302, {"Location": "/b?x=1"}, b""),
        "/b?x=1": (308, {"Location": "http://other.example/c"}, b"moved"),
        "/c": (200, {}, b"[1]"),
        "/loop": (301, {"Location": "loop"}, b""),
        "/nowhere": (303, {}, b""),
        "/file": (302, {"Location": "file:///etc/passwd"}, b""),
    })
    assert ask("a") == Reply(200, "[1]", None)
    assert [netloc for netloc, _, _ in scripted.asked] == ["api.example", "api.example", "other.example"]
    scripted.asked.clear()
    assert ask("loop") == Reply(301, None, "HTTP 301") and len(scripted.asked) == 11
    assert ask("nowhere") == Reply(303, None, "HTTP 303")
    assert "unknown URL type" in ask("file").error


def test_proxies_are_used(service, monkeypatch):
    monkeypatch.setattr("hazeline.sources.web.proxy_bypass", lambda host: host == "inside.example")
    answers = {"/a": (200, {}, b"[1]"), "http://api.example/a": (200, {}, b"[2]")}
    proxies = {"http": "http://me:p%40ss@proxy:3128", "https": "proxy:3128"}
    scripted = service(answers, proxies)
    assert ask("a", "http://api.example").body == "[2]"
    assert ask("a").body == "[1]"
    assert ask("a", "http://inside.example").body == "[1]"
    word = "Basic bWU6cEBzcw=="
    assert scripted.asked == [
        ("proxy:3128", "http://api.example/a", {"Proxy-Authorization": word}),
        ("proxy:3128", "/a", {}),
        ("inside.example", "/a", {}),
    ]
    assert scripted.tunnels == [("proxy:3128", "api.example", {})]


class Uneven:
    """Notes how many calls are under way; some calls are slow."""

    def __init__(self, folder, slow=()):
        self.folder, self.slow = str(folder), slow

    @contextmanager
    def client(self):
        client = Uneven(self.folder, self.slow)
        client.now, client.most, client.lock = 0, 0, threading.Lock()
        yield client
        Path(self.folder, "most").write_text(str(client.most))

    def __call__(self, url):
        with self.lock:
            self.now += 1
            self.most = max(self.most, self.now)
        time.sleep(3 if url in self.slow else 0.05)
        with self.lock:
            self.now -= 1
        return Reply(200, "[]", None)


def urls(spark, n):
    return spark.range(n).select(F.concat(F.lit("i="), F.col("id").cast("string")).alias("url"))


def test_as_many_calls_are_under_way_as_allowed(spark, tmp_path):
    assert fetch_responses(urls(spark, 600), Uneven(tmp_path), 1, 200).count() == 600
    assert int((tmp_path / "most").read_text()) == 200


def test_a_slow_call_delays_no_other(spark, tmp_path):
    start = time.perf_counter()
    slow = [f"i={number}" for number in range(0, 400, 50)]
    assert fetch_responses(urls(spark, 400), Uneven(tmp_path, slow), 1, 20).count() == 400
    # Eight slow calls of three seconds one after the other would take 24.
    assert time.perf_counter() - start < 12


class Stamped:
    def __init__(self, folder, status=200):
        self.folder, self.status = str(folder), status

    def __call__(self, url):
        Path(self.folder, uuid.uuid4().hex).write_text(repr(time.time()))
        return Reply(self.status, "[]", None)


@pytest.mark.parametrize("parallelism, concurrency", [(1, 1), (4, 8), (8, 2), (40, 1)])
def test_no_more_calls_begin_than_the_rate_allows(spark, tmp_path, parallelism, concurrency):
    fetch_responses(urls(spark, 80), Stamped(tmp_path), parallelism, concurrency, rate=40).count()
    times = sorted(float(path.read_text()) for path in tmp_path.iterdir())
    assert len(times) == 80
    rate = (len(times) - 1) / (times[-1] - times[0])
    assert rate <= 42, rate


def test_too_many_calls_widen_the_pace(monkeypatch):
    waits = []
    clock(monkeypatch, waits.append, lambda: 0.0)
    pace = Pace(1.0)
    for status in (200, 429, 429, 200):
        pace.wait()
        pace.heard(status)
    pace.wait()
    assert waits == [0, 1, 2, 4, 8] or waits == [0, 1, 2, 4, pytest.approx(7.6)]
    for _ in range(100):
        pace.heard(429)
    assert pace._factor == 64
    for _ in range(100):
        pace.heard(200)
    assert pace._factor == 1


def test_every_attempt_keeps_to_the_pace(monkeypatch):
    waits = []
    clock(monkeypatch, lambda _: None)
    pace = Pace(0.0)
    monkeypatch.setattr(pace, "wait", lambda: waits.append(1))
    opener = Opener(http_error(503), http_error(429), b"[]")
    transport = HttpTransport("https://api.example/", backoff=0, opener=opener).paced(pace)
    assert transport("a").status == 200 and len(waits) == 3 and pace._factor > 1


def test_a_rate_must_be_above_zero(spark, canned):
    with pytest.raises(ValueError, match="rate"):
        fetch_responses(urls(spark, 1), canned, 1, rate=0)


class Interrupted:
    """Ends its Python process whenever it gets to a certain call, as long as a marker is there."""

    def __init__(self, folder, marker, at):
        self.folder, self.marker, self.at = str(folder), str(marker), at

    def __call__(self, url):
        latitude = url.split("latitude=")[1].split("&")[0]
        if float(latitude) in self.at and Path(self.marker).exists():
            os._exit(1)
        Path(self.folder, uuid.uuid4().hex).write_text(latitude)
        return Reply(503, None, "HTTP 503") if latitude == "9.0" else two(latitude)

    def calls(self):
        return sorted(float(p.read_text()) for p in Path(self.folder).iterdir())


def test_a_job_that_failed_halfway_goes_on_where_it_was(spark, tmp_path, stations):
    folder, marker = tmp_path / "calls", tmp_path / "marker"
    folder.mkdir()
    marker.touch()
    places = [float(n) for n in range(1, 31)]
    at = stations(*places, 5.0)
    shares = {n: {r.n: r.p for r in _shares(spark, places)}[n] for n in places}
    # The call that ends the job is in the last share, and no other is.
    last = max(shares.values())
    broken = [n for n in places if shares[n] == last]
    canned = Interrupted(folder, marker, broken)
    arguments = (spark, at, str(tmp_path / "responses"), str(tmp_path / "rejects"), canned, "forecast", "2024-01-01", 2)
    with pytest.raises(Exception, match="[Ww]orker"):
        fetch(*arguments, share=SHARE, resume=True)
    stored = scan_table(spark, str(tmp_path / "responses")).count()
    assert stored == 30 - len(broken) == len(canned.calls()) and broken
    marker.unlink()
    replies = fetch(*arguments, share=SHARE, resume=True)
    assert replies.count() == replies.select("url").distinct().count() == 30
    expected = sorted(places + [9.0] if 9.0 not in broken else places)  # the failed call is made again
    assert canned.calls() == expected
    # A third try calls only what failed, and takes the stations as they are then.
    at = stations(*places[:10], 5.0, 5.0)
    replies = fetch(*arguments, share=SHARE, resume=True)
    assert canned.calls() == sorted(expected + [9.0])
    counts = {r.url.split("latitude=")[1].split("&")[0]: r.n_requests for r in replies.collect()}
    assert counts == {str(n): 3 if n == 5 else 1 for n in places[:10]}
    # Without resuming, all calls are made.
    before = len(canned.calls())
    fetch(*arguments, share=SHARE)
    assert len(canned.calls()) == before + 10


SHARE = 10


def _shares(spark, places):
    locations = spark.createDataFrame([(f"T{n}", n, 0.5) for n in places], LOCATION)
    requests = build_requests(locations, "forecast", "2024-01-01")
    share = F.pmod(F.xxhash64("url"), F.lit(-(-len(places) // SHARE)))
    return requests.select(F.col("Latitude").alias("n"), share.alias("p")).collect()


@pytest.mark.parametrize("status, final", [(200, True), (404, True), (429, False), (408, False), (500, False), (None, False), (302, False)])
def test_what_another_call_can_change(spark, status, final):
    assert spark.createDataFrame([(status,)], "status int").select(settled()).first()[0] is final
