"""Bytes behind image URLs."""

from __future__ import annotations

import http.client
import threading
import time
from collections import defaultdict
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from eventpipe.schemas import PLACE, RESPONSE

# (status, content type, bytes); status None where there was no response, bytes None where they were too many.
Response = tuple[int | None, str | None, bytes | None]

# Bytes that one Arrow batch of responses may reach before it is handed on.
BATCH_BYTES = 32 * 1024 * 1024
# GETs that one task has under way at a time.
IN_FLIGHT = 8
# The largest answer that is taken, and the bytes that one task holds of answers not yet in a batch.
MAX_BYTES, IN_FLIGHT_BYTES = 64 * 1024 * 1024, 128 * 1024 * 1024
READ_BYTES = 64 * 1024

# When a GET is tried again:
#
# =========================================  ==========================================
# no answer, broken answer                   after the back-off
# a kept connection that the server dropped  at once, on a new one; counts as no attempt
# 429, 503                                   after Retry-After in seconds, else back-off
# 500, 502, 504                              after the back-off
# any other status                           never
# =========================================  ==========================================
ATTEMPTS = 4
RETRIED = (429, 500, 502, 503, 504)
TOLD_WHEN = (429, 503)
BACK_OFF, LONGEST_WAIT = 0.5, 30.0
REDIRECTS, REDIRECTED = 5, (301, 302, 303, 307, 308)
# Connections that wait for the next GET to their host.
KEPT_PER_HOST = 8


def back_off(attempt: int) -> float:
    """Seconds before the next attempt; the first is number 0."""
    return min(BACK_OFF * 2**attempt, LONGEST_WAIT)


def is_safe_redirect(old: str, new: str, schemes: tuple[str, ...]) -> bool:
    """Within the allowed schemes, never from https to http."""
    before, after = urlsplit(old).scheme.lower(), urlsplit(new).scheme.lower()
    return after in schemes and not (before == "https" and after == "http")


def open_connection(scheme: str, place: str, timeout: float):
    kind = http.client.HTTPSConnection if scheme == "https" else http.client.HTTPConnection
    return kind(place, timeout=timeout)


class Budget:
    """Bytes that may be held at a time, over all threads of a task."""

    def __init__(self, limit: int) -> None:
        self.limit, self.held, self.most = limit, 0, 0
        self.changed = threading.Condition()

    def take(self, n: int) -> None:
        with self.changed:
            self.changed.wait_for(lambda: self.held + n <= self.limit)
            self.held += n
            self.most = max(self.most, self.held)

    def give(self, n: int) -> None:
        with self.changed:
            self.held -= n
            self.changed.notify_all()


class HttpGet:
    """A GET that keeps connections by host, follows safe redirects, and tries again what may pass.

    An answer of over ``max_bytes`` is not read to its end: it has a status and no
    bytes. Room for an answer is taken before its body is read, by its stated
    length or for the largest one, and is given back by ``release``. ``connect``
    and ``sleep`` stand for the network and the clock.
    """

    def __init__(
        self,
        timeout: float = 30.0,
        schemes: tuple[str, ...] = ("http", "https"),
        max_bytes: int = MAX_BYTES,
        in_flight_bytes: int = IN_FLIGHT_BYTES,
        attempts: int = ATTEMPTS,
        connect: Callable = open_connection,
        sleep: Callable[[float], None] = time.sleep,
    ) -> None:
        if in_flight_bytes < max_bytes:
            raise ValueError("the largest answer must fit into the bytes in flight")
        self.timeout, self.schemes, self.max_bytes, self.in_flight_bytes = timeout, schemes, max_bytes, in_flight_bytes
        self.attempts, self.connect, self.sleep = attempts, connect, sleep
        self._begin()

    def _begin(self) -> None:
        self.budget, self.lock, self.idle = Budget(self.in_flight_bytes), threading.Lock(), defaultdict(list)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("budget", "lock", "idle")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._begin()

    def __call__(self, url: str) -> Response:
        """The answer to a URL. Its bytes count as held until they are given to ``release``."""
        answer: Response = (None, None, None)
        for attempt in range(self.attempts):
            wait_for = back_off(attempt)
            try:
                answer, told = self._follow(url)
                if answer[0] is None or answer[0] not in RETRIED:
                    return answer
                if answer[0] in TOLD_WHEN and told is not None:
                    wait_for = min(told, LONGEST_WAIT)
            except (OSError, http.client.HTTPException):
                answer = None, None, None
            except ValueError:
                return None, None, None
            if attempt + 1 < self.attempts:
                self.sleep(wait_for)
        return answer

    def release(self, answer: Response) -> None:
        if answer[2]:
            self.budget.give(len(answer[2]))

    def _follow(self, url: str) -> tuple[Response, float | None]:
        for _ in range(REDIRECTS + 1):
            parts = urlsplit(url)
            if parts.scheme.lower() not in self.schemes or not parts.netloc:
                return (None, None, None), None
            answer, told, target = self._once(url)
            target = urljoin(url, target) if target else None
            if answer[0] not in REDIRECTED or not target or not is_safe_redirect(url, target, self.schemes):
                return answer, told
            url = target
        return answer, None

    def _once(self, url: str) -> tuple[Response, float | None, str | None]:
        """(answer, seconds to wait, place of a redirect)."""
        parts = urlsplit(url)
        host = parts.scheme.lower(), parts.netloc.rpartition("@")[2]
        path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
        with self.lock:
            kept = self.idle[host].pop() if self.idle[host] else None
        for connection in (kept, None):
            fresh = connection is None
            connection = connection or self.connect(*host, self.timeout)
            try:
                connection.request("GET", path, headers={"Host": host[1], "Connection": "keep-alive"})
                found = connection.getresponse()
                break
            except (OSError, http.client.HTTPException):
                connection.close()
                if fresh:
                    raise
        try:
            kind, target, told = (found.headers.get(n) for n in ("content-type", "location", "retry-after"))
            told = float(told) if told and told.strip().isdigit() else None
            content, whole = self._body(found) if 200 <= found.status < 300 else (None, False)
            if not whole and 200 <= found.status < 300:
                connection.close()
                return (found.status, kind, None), None, None
            if not whole:
                found.read(READ_BYTES)  # a short page about the status; a longer one is not worth the connection
            closing = (found.headers.get("connection") or "").lower() == "close"
            if found.isclosed() and not closing:
                with self.lock:
                    if len(self.idle[host]) < KEPT_PER_HOST:
                        self.idle[host].append(connection)
                        connection = None
            if connection is not None:
                connection.close()
            return (found.status, kind, content), told, target
        except BaseException:
            if connection is not None:
                connection.close()
            raise

    def _body(self, found) -> tuple[bytes | None, bool]:
        """The whole body, or nothing if it is too large."""
        stated = found.headers.get("content-length")
        stated = int(stated) if stated and stated.strip().isdigit() else None
        if stated is not None and stated > self.max_bytes:
            return None, False
        room = self.max_bytes if stated is None else stated
        self.budget.take(room)
        pieces, size = [], 0
        try:
            while piece := found.read(READ_BYTES):
                size += len(piece)
                if size > room:
                    break
                pieces.append(piece)
            if size <= room and stated is not None and size < stated:
                raise http.client.IncompleteRead(b"", stated - size)
        except BaseException:
            self.budget.give(room)
            raise
        if size > room:
            self.budget.give(room)
            return None, False
        self.budget.give(room - size)
        return b"".join(pieces), True

    def close(self) -> None:
        with self.lock:
            for connections in self.idle.values():
                for connection in connections:
                    connection.close()
            self.idle.clear()


def http_get(timeout: float = 30.0, schemes: tuple[str, ...] = ("http", "https"), **more) -> HttpGet:
    """A GET that follows safe redirects and gives back any status; see ``HttpGet``."""
    return HttpGet(timeout, schemes, **more)


def as_answered(get: Callable[[str], Response], urls: Iterator[str], in_flight: int) -> Iterator[tuple[int, Response]]:
    """(number of the URL, answer) as answers come, with at most ``in_flight`` GETs under way.

    A slow host holds up its own answers only.
    """
    with ThreadPoolExecutor(in_flight) as pool:
        numbered, running = enumerate(urls), {}
        while True:
            while len(running) < in_flight and (item := next(numbered, None)):
                running[pool.submit(get, item[1])] = item[0]
            if not running:
                return
            done, _ = wait(running, return_when=FIRST_COMPLETED)
            for future in done:
                yield running.pop(future), future.result()


def fetch_with(
    get: Callable[[str], Response], tasks: int | None = None, in_flight: int = IN_FLIGHT
) -> Callable[[DataFrame], DataFrame]:
    """A fetch for ``resolve_images`` that calls ``get`` once per event, in Spark tasks.

    The rows are spread evenly first, by their places: fetching waits for the
    network, and a topic partition or one much used URL must not make one task
    fetch it all. The number of tasks is that of the shuffle partitions if not given.
    """

    def fetch(events: DataFrame) -> DataFrame:
        count = tasks or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        spread = events.repartition(count, *PLACE)
        schema = T.StructType(events.schema.fields + RESPONSE.fields)

        def answers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            release, close = getattr(get, "release", None), getattr(get, "close", None)
            for batch in batches:
                numbers, responses, size = [], [], 0
                for number, response in as_answered(get, batch["image_url"], in_flight):
                    if release:
                        release(response)
                    numbers.append(number)
                    responses.append(response)
                    size += len(response[2] or b"")
                    if size >= BATCH_BYTES:
                        yield _joined(batch, numbers, responses)
                        numbers, responses, size = [], [], 0
                if responses:
                    yield _joined(batch, numbers, responses)
            if close:
                close()

        return spread.mapInPandas(answers, schema)

    return fetch


def _joined(batch: pd.DataFrame, numbers: list[int], responses: list[Response]) -> pd.DataFrame:
    part = batch.iloc[numbers].reset_index(drop=True)
    status, types, contents = zip(*responses)
    return part.assign(
        status=pd.array(status, dtype="Int32"),
        response_type=pd.Series(types, dtype=object),
        response_content=pd.Series(contents, dtype=object),
    )


def fetch_from(answers: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A fetch from a table ``url, status, content_type, content``, a URL at most once.

    A URL that very many events name is a skewed key of the left side only;
    adaptive execution splits it, and broadcasts the table if it is small.
    """
    table = answers.select(
        F.col("url").alias("image_url"),
        F.col("status").cast("int").alias("status"),
        F.col("content_type").alias("response_type"),
        F.col("content").alias("response_content"),
    )

    def fetch(events: DataFrame) -> DataFrame:
        return events.join(table, "image_url", "left")

    return fetch
