"""Streams of a fixed number of lines per batch."""

import os
import random

import pytest

from loglathe import each_batch, read_paced_lines


class Feed:
    """A folder of log files, each later than the one before, and the batches read from it."""

    def __init__(self, spark, base):
        self.spark, self.base, self.count, self.batches, self.fail_at = spark, base, 0, {}, None
        (base / "in").mkdir()

    def add(self, name, data):
        path = self.base / "in" / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(data if isinstance(data, bytes) else data.encode())
        self.count += 1
        os.utime(path, ns=(10**18 + self.count, 10**18 + self.count))

    def write(self, batch, number):
        rows = [r["raw_log"] for r in batch.collect()]
        self.batches.setdefault(number, []).append(rows)
        if number == self.fail_at:
            raise OSError("disk full")

    def run(self, lines, piece=1 << 20, now=False):
        frame = read_paced_lines(self.spark, str(self.base / "in"), lines, piece)
        query = each_batch(frame, self.write, str(self.base / "cp"), "append", trigger="0 seconds", available_now=now)
        try:
            query.awaitTermination(60) if now else query.processAllAvailable()
        finally:
            query.stop()

    def last(self):
        return [self.batches[n][-1] for n in sorted(self.batches)]


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_batches_are_full_over_ends_of_files(feed):
    feed.add("b.log", "".join(f"b {i}\n" for i in range(10)) + "\n \r\nlast of b")  # the first by time
    feed.add("a/a.log", "\n".join(f"a {i} é" for i in range(7)) + "\r\n")
    feed.add("_hidden", "no line\n")
    feed.add("empty.log", "")
    feed.run(4, piece=5)
    wanted = [f"b {i}" for i in range(10)] + ["last of b"] + [f"a {i} é" for i in range(7)]
    assert [sorted(b) for b in feed.last()] == [sorted(wanted[i : i + 4]) for i in range(0, 18, 4)]


def test_goes_on_with_the_next_line_after_restarts(feed):
    feed.add("1.log", "".join(f"1 {i}\n" for i in range(9)))
    feed.run(4, now=True)  # one batch
    assert feed.last() == [["1 0", "1 1", "1 2", "1 3"]]
    feed.run(2)
    feed.add("2.log", "2 0\n2 1\n2 2\n")
    feed.run(2)
    assert [len(b) for b in feed.last()] == [4, 2, 2, 1, 2, 1]
    assert sorted(sum(feed.last(), [])) == sorted([f"1 {i}" for i in range(9)] + ["2 0", "2 1", "2 2"])
    feed.run(2)
    assert len(feed.batches) == 6  # nothing new, no batch


def test_failed_batch_is_read_again_as_it_was(feed):
    feed.add("1.log", "".join(f"1 {i}\n" for i in range(5)))
    feed.fail_at = 1
    with pytest.raises(Exception, match="disk full"):
        feed.run(2)
    # What arrives later, even with an earlier name, does not change the batch.
    feed.add("0.log", "0 0\n")
    feed.fail_at = None
    feed.run(3)
    assert feed.batches == {0: [["1 0", "1 1"]], 1: [["1 2", "1 3"], ["1 2", "1 3"]], 2: [["1 4", "0 0"]]}


@pytest.mark.parametrize("piece", [1, 7, 64, 1 << 20])
def test_any_piece_gives_the_same_lines(feed, piece):
    rng = random.Random(piece)
    texts = ["".join(rng.choice(["x", "é", " ", "\n", "\r\n", "yz"]) for _ in range(rng.randrange(60))) for _ in range(3)]
    for i, text in enumerate(texts):
        feed.add(f"{i}.log", text)
    lines = [line.strip() for text in texts for line in text.split("\n") if line.strip()]
    feed.run(9, piece)
    assert [sorted(b) for b in feed.last()] == [sorted(lines[i : i + 9]) for i in range(0, len(lines), 9)]


def test_odd_bytes_and_long_lines(feed):
    long = "z" * (3 << 20)
    feed.add("1.log", b"\xff\xfe caf\xc3\xa9\n" + long.encode() + b"\nend")
    feed.run(2, piece=1 << 19)
    assert feed.last() == [["�� café", long], ["end"]]


def test_no_folder_and_no_lines(spark, feed):
    feed.run(3)
    assert sum(feed.last(), []) == []
    feed.add("1.log", "\n\n  \n")
    feed.run(3)
    assert sum(feed.last(), []) == []
    with pytest.raises(ValueError, match="at least one"):
        read_paced_lines(spark, "x", 0)
