import json
import socketserver
import struct
import threading
import time

import pytest

from skyfold.sources.feed import Feed, FeedClosed, MessageFeed, stream_feed

HEAD = struct.Struct(">QqI")
NOON = 1_782_561_600_000_000


class Served:
    """A feed on a local socket. breaks: bytes after which connections are cut, one after another."""

    def __init__(self, lanes, breaks=(), port=0):
        self.lanes, self.first, self.breaks, self.cut, self.commits = lanes, dict.fromkeys(lanes, 0), list(breaks), 0, []
        outer = self

        class Handler(socketserver.StreamRequestHandler):
            def handle(self):
                left = outer.breaks.pop(0) if outer.breaks else None
                for line in self.rfile:
                    what, *rest = line.decode().split()
                    if what == "lanes":
                        out = json.dumps({k: [outer.first[k], len(v)] for k, v in outer.lanes.items()}).encode() + b"\n"
                    elif what == "commit":
                        outer.commits.append((rest[0], int(rest[1])))
                        outer.first[rest[0]] = max(outer.first[rest[0]], int(rest[1]))
                        out = b"ok\n"
                    else:
                        own, a, b = outer.lanes[rest[0]], int(rest[1]), int(rest[2])
                        assert a >= outer.first[rest[0]], "a committed message was asked for again"
                        out = b"".join(HEAD.pack(k, NOON + 1_000_000 * k, len(own[k])) + own[k] for k in range(a, b))
                    if left is not None and len(out) > left:
                        self.wfile.write(out[:left])
                        outer.cut += 1
                        return
                    self.wfile.write(out)
                    left = left - len(out) if left is not None else None

        class Server(socketserver.ThreadingTCPServer):
            allow_reuse_address, daemon_threads = True, True

        self.server = Server(("127.0.0.1", port), Handler)
        self.port = self.server.server_address[1]
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def end(self):
        self.server.shutdown()
        self.server.server_close()


@pytest.fixture
def served():
    made = []

    def make(*a, **b):
        made.append(Served(*a, **b))
        return made[-1]

    yield make
    for s in made:
        s.end()


def test_reading_goes_on_after_every_break(served):
    own = [bytes([k]) * (k % 7) for k in range(50)]
    feed = served({"AB01": own}, breaks=[0, 5, 23, 100, 21, 300])
    client = Feed("127.0.0.1", feed.port, first_s=0.001, most_s=0.004)
    assert [(p, b) for p, _, b in client.read("AB01", 3, 50)] == list(enumerate(own))[3:]
    assert client.reconnects == feed.cut >= 5
    assert client.lanes() == {"AB01": (0, 50)}
    client.close()


def test_pauses_double_up_to_the_most_and_begin_again(served, monkeypatch):
    slept = []
    monkeypatch.setattr(time, "sleep", slept.append)
    with pytest.raises(FeedClosed):
        Feed("127.0.0.1", 1, attempts=8).lanes()
    assert slept == [1, 2, 4, 8, 16, 30, 30]
    slept.clear()
    feed = served({"AB01": [b"xxxx"] * 4}, breaks=[0, 0, 0, 30, 0])
    client = Feed("127.0.0.1", feed.port)
    assert len(list(client.read("AB01", 0, 4))) == 4
    assert slept == [1, 2, 4, 1, 2]  # the fourth session had begun before it broke
    client.close()


def run(spark, feed, place, out, **options):
    stream = stream_feed(spark, f"feed://127.0.0.1:{feed.port}", firstSeconds=0.01, mostSeconds=0.05, **options)
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", place).trigger(availableNow=True).start()


def found(spark, out):
    return sorted((r.path, bytes(r.content)) for r in spark.read.parquet(out).collect())


def test_stream_survives_breaks_and_a_restart_without_loss_or_repeats(spark, served, tmp_path):
    lanes = {s: [f"{s}{k}".encode() for k in range(n)] for s, n in (("AB01", 37), ("AB02", 5), ("ZZ99", 3))}
    place, out = str(tmp_path / "offsets"), str(tmp_path / "out")
    feed = served({k: v[:20] for k, v in lanes.items()}, breaks=[None, 40, 90, 200, None, 60])
    more = {"sensors": ["AB01", "AB02"], "prefetch": 30, "stretch": 7}
    run(spark, feed, place, out, **more).awaitTermination()
    assert feed.cut >= 2
    assert [c for _, c in found(spark, out)] == lanes["AB01"][:20] + lanes["AB02"]
    first, port = dict(feed.first), feed.port
    feed.end()
    again = served(lanes, port=port)  # the feed comes back with what it had not been told to forget, and more
    again.first.update(first)
    run(spark, again, place, out, **more).awaitTermination()
    expected = sorted((f"{s}/{k:020d}", m) for s in ("AB01", "AB02") for k, m in enumerate(lanes[s]))
    assert found(spark, out) == expected


def test_a_failed_batch_is_read_again(spark, served, tmp_path):
    """The sink fails after it has read: the offsets are Spark's, so the same messages come again, and none is committed
    before."""
    feed = served({"AB01": [bytes([k]) for k in range(10)]})
    seen = []

    def write(batch, number):
        seen.append((number, sorted(bytes(r.content) for r in batch.collect())))
        if len(seen) == 1:
            raise ValueError("down")

    spark.dataSource.register(MessageFeed)
    for _ in range(2):
        stream = stream_feed(spark, f"feed://127.0.0.1:{feed.port}")
        query = stream.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "offsets")).trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        except Exception as e:
            assert "down" in str(e) and not feed.commits
    assert seen == [(0, [bytes([k]) for k in range(10)])] * 2
