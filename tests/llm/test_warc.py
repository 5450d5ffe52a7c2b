import hashlib
import random

import pytest
from coursewise.llm import warc as W
from coursewise.session import scratch_path


def archive(payloads, gz):
    records = [W.record(i, "http://a/", p, hashlib.sha256(p).hexdigest(), None, len(p)) for i, p in enumerate(payloads)]
    return [W.gzip_member(r) + W._EMPTY_MEMBER if gz else r for r in records]


def salvaged(data):
    return list(W.salvage(lambda a, n: data[a:a + n], len(data)))


def ids(found):
    return [n for x in found if x[0] == "record" and (n := W._page(x[2].get("warc-record-id"))) is not None]


PAYLOADS = [random.Random(7).randbytes(k * 97 % 3000) for k in range(25)] + [
    b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 3, W.gzip_member(b"x" * 300) * 2]


@pytest.mark.parametrize("gz", [True, False])
def test_whole_archive_round_trip(gz):
    found = salvaged(b"".join(archive(PAYLOADS, gz)))
    assert [x[0] for x in found] == ["record"] * len(PAYLOADS)
    assert [W.payload_of(x[2], x[3]) for x in found] == PAYLOADS


@pytest.mark.parametrize("gz", [True, False])
@pytest.mark.parametrize("damage", ["flip", "cut", "junk", "truncate"])
def test_later_records_are_recovered(gz, damage):
    rng = random.Random(f"{gz}{damage}")
    parts = archive(PAYLOADS, gz)
    for _ in range(40):
        k = rng.randrange(len(parts))  # the last two hold records and members of their own
        start = sum(map(len, parts[:k]))
        n = len(parts[k]) - (len(W._EMPTY_MEMBER) if gz else 0)
        data = bytearray(b"".join(parts))
        want = [i for i in range(len(parts)) if i != k]
        if damage == "flip":
            data[start + rng.randrange(n)] ^= rng.randint(1, 255)
        elif damage == "cut":
            a = start + rng.randrange(n)
            del data[a:min(start + n, a + rng.randint(1, 50))]
        elif damage == "junk":
            data[start:start] = rng.randbytes(40)
            want = list(range(len(parts)))
        else:
            del data[start + rng.randrange(1, n):]
            want = list(range(k))
        data = bytes(data)
        found = salvaged(data)
        # a changed byte in the headers of a plain record, or of a gzip member, may pass every check
        assert set(want) <= set(ids(found))
        gaps = [(x[1], x[1] + x[2]) for x in found if x[0] == "gap"]
        assert all(a < z <= len(data) for a, z in gaps)
        if sum(x[0] == "record" for x in found) < len(parts) or damage == "junk":
            assert gaps and gaps[0][0] >= start
        if damage != "truncate":  # an archive that ends in a payload leaves open whose its records are
            assert all(x[3] != b"abc" for x in found if x[0] == "record")
        for x in found:
            if x[0] == "record" and damage != "flip" and x[3] != b"abc" and (n := W._page(x[2].get("warc-record-id"))) is not None:
                assert W.payload_of(x[2], x[3]) == PAYLOADS[n]


def test_records_of_one_member():
    records = archive(PAYLOADS, False)
    for k in range(len(records)):
        broken = bytearray(records[k])
        broken[-10] ^= 1
        found = salvaged(W.gzip_member(b"".join([*records[:k], bytes(broken), *records[k + 1:]])))
        assert ids(found) == [i for i in range(len(records)) if i != k]
        assert [x[0] for x in found].count("gap") == 1 and len(found) == len(records)


def test_member_that_breaks_off():
    rng = random.Random(9)
    records = archive([rng.randbytes(20_000) for _ in range(40)], False)
    member, later = W.gzip_member(b"".join(records)), W.gzip_member(archive([b"later"], False)[0])
    for _ in range(20):
        at = rng.randrange(len(member) // 4, len(member) - 10)
        for data in (member[:at], member[:at] + later, member[:at] + bytes([member[at] ^ 255]) + member[at + 1:] + later):
            got = ids(salvaged(data))
            whole = at // (len(member) // 40) - 2
            assert got[:whole] == list(range(whole)) and any(x[0] == "gap" for x in salvaged(data))
            assert data is member[:at] or got[-1] == 0 or len(data) == at


def test_records_without_digests_wait_for_the_member():
    plain = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:7>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    member = W.gzip_member(plain * 3)
    assert len(ids(salvaged(member))) == 3
    assert [x[0] for x in salvaged(member[:-8] + bytes(8))] == ["gap"]


def test_whole_record_inside_a_damaged_one():
    inner = W.record(777, "http://a/", b"inner" * 30, hashlib.sha256(b"inner" * 30).hexdigest(), None, 150)
    for payload in (inner, b"before " + inner, inner * 3):
        parts = archive([b"first", payload, b"last"], False)
        for at in (2, 30, len(parts[1]) - len(payload) - 4 + 3, len(parts[1]) - 6):
            broken = bytearray(parts[1])
            broken[at] ^= 1
            for lost in (0, 5):
                data = parts[0] + bytes(broken[:40]) + bytes(broken[40 + lost:]) + parts[2]
                assert set(ids(salvaged(data))) <= {0, 1, 2} and {0, 2} <= set(ids(salvaged(data)))


def pages(spark):
    big, small = "<p>é" + "a" * 200, "tiny"
    rows = [(5, "u5", big), (2, "u2", big), (9, None, big), (1, "u\r\n1", None), (3, "u3", ""), (4, "u4", small),
            (6, "u6", small), (None, "n", big), (2, "u2", big), (7, "u7", "WARC/1.1\r\n\r\n" + "z" * 300)]
    return rows, spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, length int")


@pytest.mark.parametrize("compress", [True, False])
def test_pages_round_trip(spark, compress):
    rows, df = pages(spark)
    path = scratch_path(spark, "warc")
    W.write_archives(df, path, compress=compress, records_per_file=3)
    got = W.read_archives(spark, path).collect()
    assert {r.kind for r in got} == {"record"}
    lowest = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if len(p) >= 100 and i is not None:
            lowest[p] = min(i, lowest.get(p, i))
    want = []
    for i, _, h in rows:
        p = (h or "").encode()
        ref = lowest.get(p) if lowest.get(p) != i else None
        want.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if ref is not None else "response", ref,
                     None if ref is not None else p))
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
              None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(found, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("compress", [True, False])
def test_very_long_urls(spark, compress):
    urls = {k: "http://a/" + "é?" * n for k, n in enumerate((5, 21_800, 21_900, 70_000, 800_000))}
    rows = [(k, u, "<p>" + "b" * 300, "x", 1) for k, u in urls.items()]
    path = scratch_path(spark, "warc")
    W.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string, digest string, length int"), path, compress=compress)
    got = W.read_archives(spark, path).collect()
    assert {r.kind for r in got} == {"record"} and {r.page_id: r.uri for r in got} == urls


def test_header_end_between_two_reads():
    p = b"x" * 10
    for n in range(W._HEADER - 450, W._HEADER + 8):
        r = W.record(1, "u" * n, p, hashlib.sha256(p).hexdigest(), None, len(p))
        assert [x[0] for x in salvaged(r)] == ["record"]


def test_empty(spark):
    _, df = pages(spark)
    path = scratch_path(spark, "warc")
    W.write_archives(df.limit(0), path)
    assert W.read_archives(spark, path).count() == 0
