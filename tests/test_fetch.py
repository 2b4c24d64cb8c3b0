"""GETs against a made-up network and clock."""

import http.client
import pickle
import threading
import time
from collections import Counter

import pytest

from eventpipe.operators.images import resolve_linked
from eventpipe.sources.fetch import HttpGet, as_answered, back_off, fetch_with, is_safe_redirect


class Answer:
    def __init__(self, status, body=b"", headers=None, stated=True, pause=0):
        self.status, self.left, self.pause = status, body, pause
        self.headers = {"content-type": "image/png", **(headers or {})}
        if stated:
            self.headers.setdefault("content-length", str(len(body)))

    def read(self, n):
        time.sleep(self.pause)
        piece, self.left = self.left[:n], self.left[n:]
        return piece

    def isclosed(self):
        return not self.left


class Network:
    """``script[url]``: answers or errors, one for each request, the last one for all that follow."""

    def __init__(self, **hosts):
        self.script, self.opened, self.asked, self.slept = hosts, Counter(), Counter(), []
        self.lock = threading.Lock()

    def connect(self, scheme, place, timeout):
        with self.lock:
            self.opened[place] += 1
        return Connection(self, place)

    def get(self, **settings):
        return HttpGet(connect=self.connect, sleep=self.slept.append, **settings)


class Connection:
    def __init__(self, network, place):
        self.network, self.place, self.closed = network, place, False

    def request(self, method, path, headers):
        assert method == "GET" and headers["Host"] == self.place
        self.path = path

    def getresponse(self):
        steps = self.network.script[self.place]
        with self.network.lock:
            n = self.network.asked[self.place]
            self.network.asked[self.place] += 1
        step = steps[min(n, len(steps) - 1)]
        step = step(self.path) if callable(step) and not isinstance(step, type) else step
        if isinstance(step, Exception) or isinstance(step, type):
            raise step
        return step

    def close(self):
        self.closed = True


def ok(body=b"bytes", **more):
    return lambda path: Answer(200, body, **more)


def test_connections_are_kept_by_host():
    network = Network(a=[ok()], b=[ok()], c=[ok(headers={"connection": "close"})])
    get = network.get()
    for _ in range(5):
        assert all(get(f"http://{host}/x") == (200, "image/png", b"bytes") for host in "abc")
    assert network.opened == {"a": 1, "b": 1, "c": 5} and network.slept == []


def test_a_kept_connection_that_was_dropped_is_no_failed_attempt():
    network = Network(a=[ok(), http.client.RemoteDisconnected(), ok()])
    get = network.get(attempts=1)
    assert [get("http://a/")[0] for _ in range(2)] == [200, 200]
    assert network.opened == {"a": 2} and network.slept == []


@pytest.mark.parametrize(
    "answers, result, slept",
    [
        ([Answer(503), Answer(500), ok()], 200, [0.5, 1.0]),
        ([OSError(), TimeoutError(), ok()], 200, [0.5, 1.0]),
        ([OSError()], None, [0.5, 1.0, 2.0]),
        ([Answer(429, headers={"retry-after": "7"}), Answer(429, headers={"retry-after": "9999"}), ok()], 200, [7.0, 30.0]),
        ([Answer(503, headers={"retry-after": "Wed, 21 Oct"}), ok()], 200, [0.5]),
        ([Answer(502, headers={"retry-after": "7"}), ok()], 200, [0.5]),
        ([lambda path: Answer(504)], 504, [0.5, 1.0, 2.0]),
        ([Answer(404), ok()], 404, []),
        ([Answer(200, b"cut", {"content-length": "9"}), ok()], 200, [0.5]),
    ],
)
def test_what_is_tried_again(answers, result, slept):
    network = Network(a=answers)
    get = network.get()
    answer = get("http://a/x?y=1")
    assert answer[0] == result and network.slept == slept
    get.release(answer)
    assert get.budget.held == 0
    assert back_off(20) == 30.0


def test_redirects():
    network = Network(
        a=[lambda path: Answer(302, b"moved", {"location": "/next" if path == "/" else "http://b/z"})], b=[ok()],
        s=[lambda path: Answer(301, headers={"location": "http://b/"})], loop=[lambda path: Answer(307, headers={"location": "http://loop/"})],
    )
    get = network.get()
    assert get("http://a/") == (200, "image/png", b"bytes")
    assert get("https://s/")[0] == 301
    assert get("http://loop/")[0] == 307 and network.asked["loop"] == 6
    assert not is_safe_redirect("http://a/", "ftp://b/", ("http", "https"))
    assert is_safe_redirect("http://a/", "https://b/", ("http", "https"))


@pytest.mark.parametrize("stated", [True, False])
def test_large_answers_have_a_status_and_no_bytes(stated):
    network = Network(a=[ok(b"x" * 101, stated=stated)], b=[ok(b"y" * 100, stated=stated)])
    get = network.get(max_bytes=100, in_flight_bytes=100)
    assert get("http://a/") == (200, "image/png", None)
    answer = get("http://b/")
    assert answer == (200, "image/png", b"y" * 100) and get.budget.held == 100
    get.release(answer)
    assert get.budget.held == 0


@pytest.mark.parametrize("stated", [True, False])
def test_bytes_in_flight_are_bounded(stated):
    network = Network(a=[ok(b"z" * 40, stated=stated, pause=0.002)])
    get = network.get(max_bytes=50, in_flight_bytes=110)
    got = []
    for number, answer in as_answered(get, [f"http://a/{i}" for i in range(40)], 8):
        time.sleep(0.001)
        get.release(answer)
        got.append(number)
    assert sorted(got) == list(range(40)) and get.budget.most <= 110 and get.budget.held == 0
    with pytest.raises(ValueError):
        HttpGet(max_bytes=2, in_flight_bytes=1)


def test_a_slow_host_holds_up_nobody():
    network = Network(slow=[ok(pause=0.3)], fast=[ok()])
    urls = ["http://slow/"] + [f"http://fast/{i}" for i in range(20)]
    assert [n for n, _ in as_answered(network.get(), urls, 2)][-1] == 0


def test_it_travels_to_tasks():
    get = pickle.loads(pickle.dumps(HttpGet(timeout=3.0, max_bytes=7)))
    assert (get.timeout, get.max_bytes, get.budget.held) == (3.0, 7, 0)
    assert get("ftp://x/") == (None, None, None) and get("http://[bad/") == (None, None, None)


def test_large_answers_are_quarantined_with_a_reason(spark, topic):
    import json

    from eventpipe.operators.parse import good_events, parse_events

    values = [json.dumps({"eventType": "IMAGE", "eventTime": "2024-01-05T00:00:00Z", "imageUrl": f"http://x/{n}"}) for n in ("ok", "huge", "empty")]
    records = topic(*values)
    events = good_events(parse_events(records.selectExpr("*", "timestamp AS inserted_at")))

    def get(url):
        return 200, "image/png", None if url.endswith("huge") else b"" if url.endswith("empty") else b"ok"

    rows = {r.src_offset: (r.content, r.reason, r.value) for r in resolve_linked(events, fetch_with(get, 2)).collect()}
    assert rows == {0: (b"ok", None, None), 1: (None, "fetch_too_large", values[1]), 2: (b"", None, None)}
