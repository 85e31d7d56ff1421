"""WARC archives and URL filter."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from ordersight.llm import urls, warc
from ordersight.llm.queries import op4_warc, op5_url_filter


def _reader(data):
    return lambda at, n: data[at : at + n]


def test_every_record_is_owned_by_one_range():
    rng = random.Random(4)
    payloads = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 3, 200, 5000]))) + warc.MAGIC * rng.randint(0, 3) for _ in range(60)]
    members = [warc.encode_record(i, f"http://a/{i}\r\nX: y", p, hashlib.sha256(p).hexdigest(), None) for i, p in enumerate(payloads)]
    starts = np.cumsum([0, *map(len, members)]).tolist()
    data = b"".join(members)
    for size in (1, 2, 7, 100, 1000, 4096, 10**9):
        if size < 7 and len(data) > 50_000:
            data_ = b"".join(members[:8])
            count = 8
        else:
            data_, count = data, len(members)
        got = [r for a in range(0, len(data_), size) for r in warc.records_in(_reader(data_), a, min(a + size, len(data_)))]
        assert [at for at, _ in got] == starts[:count]
        assert [warc.decode_record(d)["payload"] for _, d in got] == payloads[:count]


def test_false_magic_is_skipped_and_broken_records_raise():
    other = zlib.compressobj(6, zlib.DEFLATED, 31)
    noise = b"xx" + warc.MAGIC + b"junk" + other.compress(b"not a record") + other.flush()
    good = warc.encode_record(1, None, b"p" * 300, "d", None)
    assert [at for at, _ in warc.records_in(_reader(noise + good), 0, len(noise + good))] == [len(noise)]
    cut = noise + good[:-20]
    try:
        list(warc.records_in(_reader(cut), 0, len(cut)))
    except ValueError:
        pass
    else:
        raise AssertionError("a cut record must not pass")


def _brute_warc(rows):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        p = (html or "").encode()
        again = i is not None and len(p) >= 100 and first[html or ""] < i
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", first[html or ""] if again else None))
    return sorted(out, key=str)


def test_warc_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(6)
    big = "<p>ß" * 40
    rows = [(i, f"http://h/{i}", rng.choice([big, "short", "é" * 99, "x" * 99, "x" * 100, None, "", f"own {i} " * rng.randint(1, 400)])) for i in range(200, 0, -1)]
    rows += [(None, None, big), (None, "u", big), (7, "http://same", big), (7, None, big), (-3, "http://neg", "x" * 100), (900, "u", "long " * 60_000)]
    for name, some in (("many", rows), ("none", [])):
        path = str(tmp_path / name)
        spark.createDataFrame([(*r, "extra") for r in some], "page_id long, url string, html string, digest string").repartition(4).write.parquet(f"{path}/pages.parquet")
        assert sorted(map(tuple, op4_warc(spark, path).collect()), key=str) == _brute_warc(some)


def test_records_with_very_long_urls_are_kept(spark, tmp_path):
    draw = random.Random(8)
    long = "http://a.org/" + "".join(draw.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(400_000))
    rows = [(1, "http://a.org/", "one" * 50), (2, long, "two" * 50), (3, long + "x", "two" * 50), (4, None, "four")]
    path = str(tmp_path / "sf")
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{path}/pages.parquet")
    got = {r["page_id"]: (r["payload_bytes"], r["record_type"], r["refers_to"]) for r in op4_warc(spark, path).collect()}
    assert got == {1: (150, "response", None), 2: (150, "response", None), 3: (150, "revisit", 2), 4: (4, "response", None)}
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w"), "page_id", "url", "html")
    for split in (1 << 16, 1 << 24):
        assert {r["url"] for r in warc.read_archives(spark, str(tmp_path / "w"), split).collect()} == {r[1] for r in rows}


def test_a_record_without_a_whole_header_is_an_error():
    broken = zlib.compressobj(4, zlib.DEFLATED, 31)
    data = broken.compress(b"WARC/1.1\r\nWARC-Type: response") + broken.flush()
    [(_, record)] = warc.records_in(lambda at, n: data[at : at + n], 0, len(data))
    with pytest.raises(ValueError):
        warc.decode_record(record)


def test_small_ranges_read_the_same(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"page {i} " * 50) for i in range(120)]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), str(tmp_path / "w"), "page_id", "url", "html")
    whole = warc.read_archives(spark, str(tmp_path / "w"))
    pieces = warc.read_archives(spark, str(tmp_path / "w"), split_bytes=333)
    want = sorted((r["page_id"], r["url"], bytes(r["payload"])) for r in whole.collect())
    assert want == sorted((i, u, h.encode()) for i, u, h in rows)
    assert want == sorted((r["page_id"], r["url"], bytes(r["payload"])) for r in pieces.collect())


# -- URLs ---------------------------------------------------------------------


def _plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def _plain_rule(host, path):
    best = None
    for verdict, h, p in urls.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return best


def test_url_query_equals_plain_rules(spark, tmp_path):
    odd = [None, "", "no scheme", "http://", "HTTP://WWW.Example.NET/en/x?y#z", "http://example.net/en", "http://net", "http://net/", "http://anet/", "x://a.net?q=/", "http://É.ORG/fr/1", "http://org/fr/", "a://b://c.net/x", "http://example.com/de/", "http://my.example.com/de/x", "http://h\n.net/a\nb", "http://u:p@a.net:80/x", "http://x.example.com/" + "long/" * 20_000]
    rng = random.Random(1)
    common = [f"http://{rng.choice(['www.', 'blog.', ''])}{rng.choice(['aa', 'bb', 'example'])}.{rng.choice(['net', 'com', 'org'])}/{rng.choice(['en', 'de', 'fr', 'es'])}/{i}" for i in range(400)]
    rows = [(i, u, "h", "v") for i, u in enumerate(odd + common)] + [(None, "http://a.net/", "h", "v"), (0, None, None, None)]
    spark.createDataFrame(rows, "page_id long, url string, host string, verdict string").write.parquet(str(tmp_path / "pages.parquet"))
    got = op5_url_filter(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    want = {}
    for i, u, *_ in rows:
        host, path = _plain_parts(u)
        want.setdefault(i, []).append((host, path, (_plain_rule(host, path) or (None,))[0]))
    for r in got:
        assert (r["host"], r["path"], r["rule"]) in want[r["page_id"]]
        fixed = _plain_rule(r["host"], r["path"])
        assert r["verdict"] == (fixed[1] if fixed else "block" if r["probability"] > 0.5 else "allow")
    # The model has learned what its table shows: hosts under net are blocked.
    decided = [r for r in got if r["rule"]]
    assert np.mean([(r["probability"] > 0.5) == (r["verdict"] == "block") for r in decided]) > 0.95
    empty = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(empty, "page_id", "url", urls.train(urls.labelled_urls(empty, "url"))).count() == 0


def test_model_on_unseen_urls():
    rng = random.Random(2)
    make = lambda bad: (f"{''.join(rng.choice('abcdefgh') for _ in range(6))}.{'casino-win' if bad else 'library'}.example", f"/{rng.randint(1, 999)}/", int(bad))
    model = urls.train([make(i % 2 == 0) for i in range(200)])
    assert np.mean([(model.blocks(h, p) > 0.5) == bool(y) for h, p, y in (make(i % 3 == 0) for i in range(200))]) > 0.97


def test_urls_judged_together_equal_urls_judged_alone(monkeypatch):
    draw = random.Random(4)
    pairs = [("", ""), ("a", ""), ("", "/"), ("é.org", "/ü"), ("x" * 3000, "/y" * 900)]
    pairs += [("".join(draw.choice("abc.é") for _ in range(draw.randrange(12))), "/" + "".join(draw.choice("xyz/") for _ in range(draw.randrange(30)))) for _ in range(200)]
    hosts, paths = map(list, zip(*pairs))
    model = urls.UrlModel(0.3, np.random.default_rng(2).normal(size=urls.BUCKETS))
    alone = [model.blocks(h, p) for h, p in pairs]
    for stretch in (1, 50, 1 << 20):
        monkeypatch.setattr(urls, "STRETCH", stretch)
        assert np.allclose(model.blocks_all(hosts, paths), alone, rtol=1e-12)
    assert model.blocks_all([], []).tolist() == []


def test_copies_of_a_url_count_once_in_the_labelled_table(spark):
    addresses = [f"http://x{i}.{'net' if i % 2 else 'example.com'}/de/{i}" for i in range(200)]
    once = spark.createDataFrame([(u,) for u in addresses], "url string")
    copied = once.union(once.filter("url like '%/de/1%'").crossJoin(spark.range(300)).select("url"))
    table = sorted(urls.labelled_urls(once, "url", each=60))
    assert sorted(urls.labelled_urls(copied, "url", each=60)) == table and len(table) == len(set(table)) > 30
