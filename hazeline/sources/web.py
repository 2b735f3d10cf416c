"""Web API calls, spread over the executors.

A *transport* is any picklable callable from a relative URL to a ``Reply``. ``HttpTransport``
calls a real service; tests pass canned ones.
"""

from __future__ import annotations

import sys
import threading
import time
from base64 import b64encode
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, nullcontext
from copy import copy
from http.client import HTTPConnection, HTTPException, HTTPResponse, HTTPSConnection
from queue import SimpleQueue
from typing import NamedTuple
from urllib.error import HTTPError
from urllib.parse import quote, unquote, urljoin, urlsplit
from urllib.request import getproxies, proxy_bypass, urlopen

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Send these helpers along with each task, so executors need no installed copy of them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: the URL parameter that carries the API key.
KEY_PARAMETER = "API_KEY"
OK, TOO_MANY = 200, 429
# Statuses that name another place to get the same from, and how often to go on to one.
REDIRECTS = (301, 302, 303, 307, 308)
MOST_REDIRECTS = 10
# A task hands on its replies in groups of so many, or of so many characters.
REPLIES_PER_BATCH = 64
CHARS_PER_BATCH = 1 << 22
# A pace that was widened narrows again by this factor with each good reply, and never widens beyond this.
NARROWING, WIDEST = 0.9, 64.0


class Reply(NamedTuple):
    status: int | None
    body: str | None
    error: str | None


Transport = Callable[[str], Reply]


class KeepAlive:
    """Opens URLs like ``urlopen``, over one connection per thread and server, kept open.

    A connection that the server has closed meanwhile is replaced. Redirects are followed, and
    the proxies that ``urllib.request.getproxies`` finds are used: of plain HTTP by asking them for the
    whole URL, of HTTPS by a tunnel.
    """

    def __init__(self) -> None:
        self._local = threading.local()
        self._all: list[HTTPConnection] = []
        self._proxies = getproxies()

    def __call__(self, url: str, timeout: float) -> Response:
        for _ in range(MOST_REDIRECTS + 1):
            reply, body = self._get(url, timeout)
            place = reply.headers.get("Location") if reply.status in REDIRECTS else None
            if place is None:
                break
            url = urljoin(url, place)
        if reply.status >= 300:
            reason = "too many redirects" if place else reply.reason
            raise HTTPError(url, reply.status, reason, reply.headers, None)
        return Response(reply.status, body)

    def _get(self, url: str, timeout: float) -> tuple[HTTPResponse, bytes]:
        parts = urlsplit(url)
        if parts.scheme not in ("http", "https"):
            raise ValueError(f"unknown URL type: {parts.scheme}")
        known = self._local.__dict__.setdefault("connections", {})
        server = parts.scheme, parts.netloc
        proxy = self._proxy(parts.scheme, parts.hostname or "")
        path, headers = parts._replace(scheme="", netloc="", fragment="").geturl() or "/", {}
        if proxy and parts.scheme == "http":
            path, headers = parts._replace(fragment="").geturl(), proxy.headers
        for fresh in (server not in known, True):
            if fresh:
                known[server] = self._connect(parts.scheme, parts.netloc, proxy, timeout)
                self._all.append(known[server])
            try:
                known[server].request("GET", path, headers=headers)
                reply = known[server].getresponse()
                return reply, reply.read()
            except (HTTPException, ConnectionError):
                known.pop(server).close()
                if fresh:
                    raise
        raise AssertionError("unreachable")

    def _proxy(self, scheme: str, host: str) -> Proxy | None:
        address = self._proxies.get(scheme) or self._proxies.get("all")
        if not address or proxy_bypass(host):
            return None
        parts = urlsplit(address if "://" in address else f"http://{address}")
        headers = {}
        if parts.username:
            user = f"{unquote(parts.username)}:{unquote(parts.password or '')}"
            headers["Proxy-Authorization"] = f"Basic {b64encode(user.encode()).decode()}"
        return Proxy(parts.netloc.rpartition("@")[2], headers)

    @staticmethod
    def _connect(scheme: str, netloc: str, proxy: Proxy | None, timeout: float) -> HTTPConnection:
        kind = HTTPSConnection if scheme == "https" else HTTPConnection
        connection = kind(proxy.netloc if proxy else netloc, timeout=timeout)
        if proxy and scheme == "https":
            connection.set_tunnel(netloc, headers=proxy.headers)
        return connection

    def close(self) -> None:
        for connection in self._all:
            connection.close()


class Proxy(NamedTuple):
    netloc: str
    headers: dict[str, str]


class Response:
    """A reply that has been read."""

    def __init__(self, status: int, body: bytes) -> None:
        self.status, self._body = status, body

    def read(self) -> bytes:
        return self._body

    def __enter__(self) -> Response:
        return self

    def __exit__(self, *_: object) -> None:
        pass


class Pace:
    """Lets the calls of one task begin no closer together than ``interval`` seconds.

    ``offset`` delays the first. A server that says it gets too many calls doubles the interval, and
    each good reply brings it back a little.
    """

    def __init__(self, interval: float, offset: float = 0.0) -> None:
        self.interval, self._factor = interval, 1.0
        self._next = time.monotonic() + offset
        self._lock = threading.Lock()

    def wait(self) -> None:
        with self._lock:
            start = max(self._next, time.monotonic())
            self._next = start + self.interval * self._factor
        time.sleep(max(0.0, start - time.monotonic()))

    def heard(self, status: int | None) -> None:
        with self._lock:
            if status == TOO_MANY:
                self._factor = min(WIDEST, self._factor * 2)
            elif status == OK:
                self._factor = max(1.0, self._factor * NARROWING)


class HttpTransport:
    """GET ``base_url + url`` with a timeout and bounded retries.

    The API key is added here, on the executor, so that it appears neither in the request and
    response tables nor in error texts. ``client`` gives a task a transport with connections of
    its own, kept open from call to call. A server that asks to wait (``Retry-After``, in seconds)
    is given that time, up to ``longest_wait``; errors that another try can't change are final.
    """

    def __init__(
        self,
        base_url: str,
        api_key: str | None = None,
        timeout: float = 30.0,
        attempts: int = 4,
        backoff: float = 1.0,
        opener: Callable = urlopen,
        longest_wait: float = 120.0,
    ) -> None:
        if attempts < 1:
            raise ValueError("attempts must be at least 1")
        self.base_url = base_url.rstrip("/") + "/"
        self._api_key = api_key
        self.timeout = timeout
        self.attempts = attempts
        self.backoff = backoff
        self.opener = opener
        self.longest_wait = longest_wait
        self.pace: Pace | None = None

    def __repr__(self) -> str:
        return f"HttpTransport({self.base_url!r})"

    @contextmanager
    def client(self) -> Iterator[HttpTransport]:
        """The same transport over kept connections; a custom opener stays as it is."""
        if self.opener is not urlopen:
            yield self
            return
        own = copy(self)
        own.opener = KeepAlive()
        try:
            yield own
        finally:
            own.opener.close()

    def paced(self, pace: Pace) -> HttpTransport:
        """The same transport, each of whose attempts keeps to the pace."""
        own = copy(self)
        own.pace = pace
        return own

    def __call__(self, url: str) -> Reply:
        asked = 0.0
        for attempt in range(self.attempts):
            if attempt:
                time.sleep(max(asked, self.backoff * 2 ** (attempt - 1)))
            if self.pace:
                self.pace.wait()
            reply, final, asked = self._try(url)
            if self.pace:
                self.pace.heard(reply.status)
            if final:
                break
        return reply

    def _try(self, url: str) -> tuple[Reply, bool, float]:
        """One call, whether its outcome would stay the same on another one, and when to try."""
        target = self.base_url + url
        if self._api_key:
            target += f"&{KEY_PARAMETER}={quote(self._api_key, safe='')}"
        try:
            with self.opener(target, timeout=self.timeout) as response:
                body = response.read().decode("utf-8")
                return Reply(response.status, body, None), True, 0.0
        except HTTPError as error:
            asked = (error.headers or {}).get("Retry-After") or ""
            error.close()
            retry = error.code == 429 or error.code >= 500
            wait = min(float(asked), self.longest_wait) if asked.isdigit() else 0.0
            return Reply(error.code, None, f"HTTP {error.code}"), not retry, wait
        except UnicodeDecodeError:
            return Reply(OK, None, "body is not UTF-8"), True, 0.0
        except Exception as error:  # connection failures, timeouts, broken bodies
            text = f"{type(error).__name__}: {error}"
            # A URL that can't be called, such as one of an unknown type.
            final = isinstance(error, ValueError) or "unknown url type" in text.lower()
            return Reply(None, None, self._redact(text)), final, 0.0

    def _redact(self, text: str) -> str:
        if not self._api_key:
            return text
        for form in (self._api_key, quote(self._api_key, safe="")):
            text = text.replace(form, "***")
        return text


class Paced:
    """A transport that keeps to a pace."""

    def __init__(self, transport: Transport, pace: Pace) -> None:
        self._transport, self._pace = transport, pace

    def __call__(self, url: str) -> Reply:
        self._pace.wait()
        reply = Reply(*self._transport(url))
        self._pace.heard(reply.status)
        return reply


@contextmanager
def _client(transport: Transport, pace: Pace | None) -> Iterator[Transport]:
    """What a task calls: a client of the transport, at the pace."""
    if pace and hasattr(transport, "paced"):
        transport, pace = transport.paced(pace), None
    with transport.client() if hasattr(transport, "client") else nullcontext(transport) as client:
        yield Paced(client, pace) if pace else client


def fetch_responses(
    requests: DataFrame,
    transport: Transport,
    parallelism: int,
    concurrency: int = 1,
    rate: float | None = None,
) -> DataFrame:
    """Call every distinct ``url`` of ``requests`` once, in ``parallelism`` tasks.

    Returns ``url, n_requests, status, body, error``, where ``n_requests`` counts the requests
    that share the URL, or adds up their ``n_requests`` if they have any. A failed call gives a row with
    an ``error``; it does not stop the others. Counting before the calls combines within the input
    partitions, so a URL shared by a large part of all requests costs no more than any other.

    Each task has ``concurrency`` calls under way as long as it has URLs: as one ends, the next begins, so
    that a slow call delays no other. The load on the API is at most ``parallelism * concurrency``
    calls at a time, and no more than ``rate`` calls begin per second, if given: each task has an equal
    part of it, slows down when told that there are too many calls, and starts at an offset of its own.
    A transport with a ``client`` method, a context manager, gives each task one client that all its
    calls share; one with a ``paced`` method keeps to the pace in all its attempts, for others each call counts.

    Write the result to a table before using it: evaluating the frame again repeats the
    calls. A lost task repeats its own share only; more tasks than cores make that share
    smaller.
    """
    if parallelism < 1 or concurrency < 1:
        raise ValueError("parallelism and concurrency must be at least 1")
    if rate is not None and rate <= 0:
        raise ValueError("rate must be above 0")
    schema = pa.schema(
        [
            ("url", pa.string()),
            ("n_requests", pa.int64()),
            ("status", pa.int32()),
            ("body", pa.string()),
            ("error", pa.string()),
        ]
    )

    def fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pace = None
        if rate is not None:
            task = TaskContext.get()
            place = task.partitionId() % parallelism if task else 0
            pace = Pace(parallelism / rate, place / rate)
        with _client(transport, pace) as client, ThreadPoolExecutor(concurrency) as threads:

            def call(url: str, n: int) -> tuple:
                try:
                    return url, n, *Reply(*client(url))
                except Exception as error:
                    return url, n, None, None, f"{type(error).__name__}: {error}"

            def table(rows: list[tuple]) -> pa.RecordBatch:
                arrays = [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)]
                return pa.RecordBatch.from_arrays(arrays, schema=schema)

            requested = (
                pair for batch in batches
                for pair in zip(batch.column("url").to_pylist(), batch.column("n_requests").to_pylist())
            )

            def replies() -> Iterator[tuple]:
                """The replies as they come, with as many calls under way as may be."""
                if concurrency == 1:
                    yield from (call(*pair) for pair in requested)
                    return
                ended: SimpleQueue = SimpleQueue()
                under_way = 0
                while True:
                    while under_way < concurrency and (pair := next(requested, None)):
                        threads.submit(call, *pair).add_done_callback(ended.put)
                        under_way += 1
                    if not under_way:
                        return
                    yield ended.get().result()
                    under_way -= 1

            rows, chars = [], 0
            for row in replies():
                rows.append(row)
                chars += len(row[3] or "")
                if len(rows) >= REPLIES_PER_BATCH or chars >= CHARS_PER_BATCH:
                    yield table(rows)
                    rows, chars = [], 0
            if rows:
                yield table(rows)

    number = F.sum("n_requests") if "n_requests" in requests.columns else F.count(F.lit(1))
    distinct = requests.groupBy("url").agg(number.alias("n_requests"))
    return distinct.repartition(parallelism).mapInArrow(
        fetch, "url string, n_requests bigint, status int, body string, error string"
    )
