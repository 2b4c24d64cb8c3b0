import gzip
import hashlib
import os
import subprocess
import sys

import pytest

from eventpipe.llm import warc
from eventpipe.llm.common import Scratch
from eventpipe.llm.warc import read_archive, write_archive

KIND = "page_id bigint, url string, html string"
LONG = "<p>" + "x" * 200


def brute_force(rows):
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    out = []
    for i, p in payloads:
        same = [j for j, q in payloads if q == p and j is not None] if len(p) >= 100 else []
        first = min(same) if same and (i is None or i != min(same)) else None
        page = None if i is None else str(i)
        kind = "response" if first is None else "revisit"
        out.append((page, len(p), hashlib.sha256(p).hexdigest(), kind, None if first is None else str(first)))
    return sorted(out, key=str)


def trip(spark, rows, **more):
    folder = Scratch(spark, "test-warc").path
    manifest = write_archive(spark.createDataFrame(rows, KIND), folder, Scratch(spark, "test-warc"), **more)
    read = read_archive(spark, folder).drop("url")
    return folder, manifest.collect(), sorted((tuple(r) for r in read.collect()), key=str)


ROWS = [(3, "http://a/é b\r\nX: y", LONG), (1, None, LONG), (2, "u", "short"), (4, "u", "short"), (5, "u", None), (None, "u", LONG),
        (6, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 30), (1, "u", LONG), (7, "u", "漢" * 400_000)]


def test_round_trip(spark):
    assert trip(spark, ROWS)[2] == brute_force(ROWS)


def test_rolled_files_hold_whole_members_and_match_the_manifest(spark):
    rows = [(i, f"http://h/{i}", f"{i} " * 500) for i in range(60)]
    folder, manifest, read = trip(spark, rows, roll_bytes=2000)
    assert read == brute_force(rows) and len(manifest) > 3
    for row in manifest:
        data = open(f"{folder}/{row.file}", "rb").read()
        assert len(data) == row.bytes and hashlib.sha256(data).hexdigest() == row.sha256
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == row.records


def test_the_same_pages_make_the_same_bytes(spark):
    a, b = (sorted((r.file, r.sha256) for r in trip(spark, ROWS)[1]) for _ in range(2))
    assert a == b


SHARDED = [(i // 3 if i % 7 else None, f"http://h/{i % 5}" if i % 11 else None, f"{i % 40} é " * (50 + i % 90)) for i in range(300)] + [(5, "u", "same")] * 9


def manifest_of(spark, frame):
    manifest = write_archive(frame, Scratch(spark, "test-warc").path, Scratch(spark, "test-warc"), shard_bytes=20_000)
    return sorted((r.file, r.records, r.bytes, r.sha256) for r in manifest.collect())


def test_shards_depend_on_the_pages_alone(spark):
    """Other partitions, another order of the input, another session, another number of cores."""
    frame = spark.createDataFrame(SHARDED, KIND)
    first = manifest_of(spark, frame)
    assert len(first) > 5 and sum(r[1] for r in first) == len(SHARDED)
    assert manifest_of(spark, frame.repartition(7).sortWithinPartitions("html")) == first
    other = spark.newSession()
    other.conf.set("spark.sql.shuffle.partitions", "13")
    assert manifest_of(other, other.createDataFrame(SHARDED[::-1], KIND)) == first
    code = (
        "import sys; sys.path[:0] = sys.argv[1:]\n"
        "from eventpipe.session import build_session\n"
        "spark = build_session('two', 'local[2]', 3, {'spark.ui.enabled': 'false', 'spark.ui.showConsoleProgress': 'false'})\n"
        "import test_warc as t\n"
        "print('rows', t.manifest_of(spark, spark.createDataFrame(t.SHARDED, t.KIND)))\n"
    )
    here = os.path.dirname(os.path.abspath(__file__))
    run = subprocess.run([sys.executable, "-c", code, here, os.path.dirname(os.path.dirname(here))], capture_output=True, text=True, timeout=300)
    assert run.stdout.strip().splitlines()[-1] == f"rows {first}", run.stderr[-2000:]


def test_one_page_id_is_spread(spark):
    for page_id in (None, 7):
        rows = [(page_id, f"http://h/{i}", f"page {i} " * 100) for i in range(200)]
        manifest = manifest_of(spark, spark.createDataFrame(rows, KIND))
        assert len(manifest) > 5 and max(r[1] for r in manifest) < 40


def test_sharded_round_trip(spark):
    assert trip(spark, SHARDED, shard_bytes=20_000)[2] == brute_force(SHARDED)


def test_files_outside_the_manifest_are_not_read(spark):
    folder, _, read = trip(spark, ROWS)
    open(f"{folder}/part-99999-00000.warc.gz", "wb").write(b"junk")
    assert sorted((tuple(r) for r in read_archive(spark, folder).drop("url").collect()), key=str) == read


def test_a_spoilt_payload_is_noticed(spark):
    folder, manifest, _ = trip(spark, [(1, "u", LONG)])
    path = f"{folder}/{manifest[0].file}"
    data = gzip.decompress(open(path, "rb").read()).replace(b"xxx", b"xyx", 1)
    open(path, "wb").write(gzip.compress(data))
    with pytest.raises(ValueError, match="digest"):
        list(warc.records_of(path))


def test_a_second_archive_in_one_place_is_refused(spark):
    folder, _, _ = trip(spark, ROWS[:1])
    with pytest.raises(OSError):
        write_archive(spark.createDataFrame(ROWS[:1], KIND), folder, Scratch(spark, "test-warc"))


def test_empty_table_and_extra_columns(spark):
    assert trip(spark, [])[2] == []
    folder = Scratch(spark, "test-warc").path
    frame = spark.createDataFrame([(1, "u", "h", "d", 1)], KIND + ", digest string, copies int")
    write_archive(frame, folder, Scratch(spark, "test-warc"))
    assert read_archive(spark, folder).first().page_id == "1"
