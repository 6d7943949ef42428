"""Whitening, ranked search and online packing against brute force and odd rows."""

from __future__ import annotations

import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm import html, lines, online_packing, ranked, sampling, warc, whitening
from tests.llm.test_corpus import DOCS, all_pairs, odd_rows, prose


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# ---------------------------------------------------------------- 11 whitening

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        *[T.StructField(c, T.StringType()) for c in ("whitened", "n", "vector", "deviation")]])


def vectors(spark, rows):
    return spark.createDataFrame([(k, v, "a", "b", None, "c") for k, v in rows], VECTORS)


def symmetric(values: list[float], seed: int) -> np.ndarray:
    q = np.linalg.qr(np.random.Generator(np.random.PCG64(seed)).standard_normal((len(values), len(values))))[0]
    a = q @ np.diag(values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [
    [9.0, 5.0, 4.999999, 3.0, 1.0, 0.5, 0.1], [2.0] * 5, [1e9, 1e9, 1.0, 1e-3, 0.0, 0.0], [7.0], [3.0, -2.0, -5.0, 1.0],
    [1 + k * 1e-9 for k in range(6)], list(range(1, 41))])
def test_slicing_finds_the_leading_eigenpairs(values):
    a = symmetric(values, len(values))
    for s in (-6.5, -1.0, 0.25, 2.5, 4.0, 1e8):
        assert whitening.count_above(a, s) == sum(v > s for v in values)
    found, vecs = whitening.leading_eigenpairs(a, 8)
    want, top = np.sort(values)[::-1][:8], max(map(abs, values))
    assert np.allclose(found, want, atol=1e-12 * top, rtol=0)
    assert np.abs(a @ vecs - vecs * found).max() < 1e-11 * top
    assert np.abs(vecs.T @ vecs - np.eye(len(found))).max() < 1e-9


def test_inertia_with_zero_diagonal():
    a = np.array([[0.0, 1.0, 0.0], [1.0, 0.0, 0.0], [0.0, 0.0, 0.0]])
    assert [whitening.count_above(a, s) for s in (-2, -0.5, 0, 0.5, 2)] == [3, 2, 1, 1, 0]


def test_whitening_against_numpy(spark):
    r = np.random.Generator(np.random.PCG64(3))
    data = (r.standard_normal((700, 12)) @ r.standard_normal((12, 12))).astype(np.float32)
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(data)]
    rows += [(900, None), (901, [float("nan")] + [0.0] * 11), (902, [None] + [0.0] * 11), (903, [float("inf")] * 12),
             (904, []), (905, [1.0, 2.0]), (906, [0.0] * 12), (None, [0.5] * 12), (5, [0.25] * 12), (5, [0.25] * 12)]
    got = whitening.op11_whitening(vectors(spark, rows).repartition(5)).toPandas()
    used = [(k, v) for k, v in rows if v and len(v) == 12 and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(1024 * np.float64(np.float32(c))) + 100_000 for c in v] for _, v in used], object)
    n, s = len(x), x.sum(axis=0)
    f = (x * n - s).astype(float) / n
    cov = f.T @ f / n
    value, vec = np.linalg.eigh(cov)
    value, vec = value[::-1][:8], vec[:, ::-1][:, :8]
    assert len(got) == 8 * n and set(got["n"]) == {n}
    deviation = Counter((k, int(sum((n * c - t) ** 2 for c, t in zip(row, s, strict=True)))) for (k, _), row in zip(used, x, strict=True))
    first = got[got["component"] == 1]
    assert Counter((None if np.isnan(k) else int(k), int(d)) for k, d in zip(first["vec_id"], first["deviation"], strict=True)) == deviation
    for c in range(8):
        mine = got[got["component"] == c + 1]
        assert np.allclose(mine["explained"], value[c] / np.trace(cov), rtol=1e-9)
        want = np.sort(f @ vec[:, c] / np.sqrt(value[c]))
        have = np.sort(mine["whitened"].to_numpy())
        assert np.allclose(have, want, atol=1e-8) or np.allclose(have, -want[::-1], atol=1e-8)
    assert set(got["identity_error"]) == {got["identity_error"][0]} and got["identity_error"][0] < 1e-9


def test_whitening_of_few_and_odd_rows(spark):
    assert whitening.op11_whitening(vectors(spark, [])).count() == 0
    assert whitening.op11_whitening(vectors(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.op11_whitening(vectors(spark, [(1, [1.0, 2.0])] * 3)).count() == 0  # no variance
    flat = whitening.op11_whitening(vectors(spark, [(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 4.0])])).collect()
    assert [(r["vec_id"], r["component"], abs(round(r["whitened"], 9)), r["explained"]) for r in sorted(flat)] == [(1, 1, 1.0, 1.0), (2, 1, 1.0, 1.0)]
    huge = whitening.op11_whitening(vectors(spark, [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])])).collect()
    assert {r["deviation"] for r in huge if r["vec_id"] != 3} == {None}  # beyond a long
    y = np.array([[1 << 30, 3], [-5, 1 << 30]])
    assert whitening.exact_products(y)[0, 0] == (1 << 60) + 25


# ---------------------------------------------------------------- 12 ranked search


def brute_ranking(docs: list[tuple], items: list[tuple], top: int = 20) -> Counter:
    split = lambda t: re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda c: c[0].lower(), t or ""))
    held = [(k, Counter(split(t))) for k, t in docs]
    held = [(k, c, sum(c.values())) for k, c in held if c]
    n, total = len(held), sum(x for _, _, x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = Counter()
    for item, text in items:
        scored = []
        for k, c, length in held:
            m = 75 + (25 * length * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in split(text) if t in c)
            if score > 0:
                scored.append((-score, k is None, k or 0, k))
        for rank, (score, _, _, k) in enumerate(sorted(scored)[:top], 1):
            out[(item, rank, k, -score)] += 1
    return out


def search_rows(spark, docs, items, **sizes) -> Counter:
    block = sizes.pop("query_block", 4)
    d = spark.createDataFrame([(*r, "x", "y") for r in docs], "doc_id long, text string, score string, term string").repartition(3)
    q = spark.createDataFrame([(*r, "x", 1) for r in items], "item_id long, text string, block string, query long")
    return Counter(tuple(r) for r in ranked.search(q, ranked.write_index(d, **sizes), query_block=block).collect())


def test_search_against_brute_force(spark):
    r = random.Random(7)
    words = [f"w{int(r.paretovariate(0.6)) % 4000}" for _ in range(60_000)]
    docs = []
    for k in range(900):
        at = r.randrange(len(words) - 400)
        docs.append((k, " ".join(words[at:at + r.choice([3, 30, 90, 300])]) + r.choice(["", ". É été, ÉTÉ w1-W2_w3"])))
    docs += [(1000 + k, docs[5][1]) for k in range(40)] + [(None, docs[5][1]), (None, None), (2000, ""), (2001, " .,!"), (7, docs[8][1])]
    docs.append((3000, "w1 w2 " * 20_000))
    items = [(k, " ".join(r.sample(words, r.choice([1, 5, 40])))) for k in range(14)]
    items += [(50, docs[5][1]), (51, None), (52, ""), (53, "unknownterm"), (54, "w1 w1 w1 W2"), (54, "w1 w1 w1 W2"), (None, "été w3")]
    want = brute_ranking(docs, items)
    assert search_rows(spark, docs, items) == want
    assert search_rows(spark, docs, items, shard_docs=37, shard_chars=5000, query_block=100) == want


def test_search_of_empty_tables(spark):
    assert search_rows(spark, [(1, "a b")], [(1, "c")]) == Counter()
    d = spark.createDataFrame([], "doc_id long, text string")
    q = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked.search(one, ranked.write_index(d)).count() == 0
    assert ranked.search(q, ranked.write_index(one.withColumnRenamed("item_id", "doc_id"))).count() == 0


def test_blocks_are_rejected_before_decompression():
    """A frequent, cheap list is opened only where its block maxima could matter."""
    docs = [[b"common", *[b"rare"] * 60] if k < 30 else [b"common", *[b"rest"] * 40] for k in range(8000)]
    shard = ranked.Shard()
    for k, terms in enumerate(docs):
        shard.add(k, terms, 1)
    rows = {r["term"]: r for batch in shard.batches(0) for r in batch.to_pylist()}
    n = np.array([len(terms) for terms in docs])
    common, rare = (ranked.PostingList(rows[t], 8000, int(n.sum())) for t in ("common", "rare"))
    got, scores = ranked.best_documents([(1, common), (5000, rare)], ranked.length_weight(n, 8000, int(n.sum())), 20)
    assert got.tolist() == list(range(20)) and len(common.blocks) < len(common.last) / 4


# ---------------------------------------------------------------- 13 online packing


def check_pieces(rows: list, docs: list[tuple], capacity: int, vocabulary: str) -> dict[int, int]:
    """Every id in one piece, offsets gapless; returns each sequence's length."""
    coder = online_packing.ByteEncoder(vocabulary)
    want = Counter()
    for doc_id, text in docs:
        want[(doc_id, tuple([*coder.tokenizer.encode(text or "", add_special_tokens=False).ids, 0]))] += 1
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[(r["doc_id"], r["doc_tokens"])].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert Counter((k, len(ids)) for (k, ids), c in want.items() for _ in range(c)) == Counter(
        {k: sum(r["start"] == 0 for r in pieces) for k, pieces in by_doc.items()})
    for (doc_id, ids), copies in want.items():
        raw = np.array(ids, "<u4")
        pieces = by_doc[(doc_id, len(ids))]
        assert sum(r["length"] for r in pieces) >= copies * len(ids)
        for r in pieces:
            if copies * len(ids) == sum(x["length"] for x in pieces):  # no other document of this id and length
                assert zlib.crc32(raw[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
    out = {}
    for k, places in sequences.items():
        end = 0
        for offset, length in sorted(places):
            assert offset == end and length > 0
            end += length
        assert end <= capacity
        out[k] = end
    assert sum(out.values()) == sum(len(ids) * c for (_, ids), c in want.items())
    return out


@pytest.mark.parametrize("sizes", [{}, {"windows": 3, "fan_in": 2}, {"capacity": 100, "windows": 5, "fan_in": 2}])
def test_online_packing_places_every_id(spark, odd, sizes):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    docs += [(100 + k, prose(k, 20 + 7 * k)) for k in range(60)] + [(200, "x <|endoftext|> y"), (201, " " * 60_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"window": F.lit("w"), "ids": F.lit(1)}).repartition(9)
    rows = online_packing.pack_online(df, **sizes).collect()
    capacity = sizes.get("capacity", online_packing.CAPACITY)
    lengths = check_pieces(rows, docs, capacity, online_packing.default_vocabulary())
    short = [n for n in lengths.values() if n != capacity]
    assert all(n & (n - 1) == 0 for n in short) and len(short) <= capacity.bit_length()  # nothing is padded


def test_online_packing_keeps_whole_what_fits():
    out = []
    packer = online_packing.Windows(10, 2, 0, lambda s, p: out.append((s, [(x[0], x[1], len(x[3])) for x in p])))
    for doc, length in enumerate([6, 7, 4, 3, 5, 25, 9]):
        packer.place([(doc, 0, length, np.arange(length))], length)
    # 4 fills the window of 6 and 3 that of 7; 25 gives two full sequences; 9 fits nowhere: the fullest is topped up
    assert out == [(0, [(0, 0, 6), (2, 0, 4)]), (1, [(1, 0, 7), (3, 0, 3)]), (3, [(5, 0, 10)]), (4, [(5, 10, 10)]),
                   (2, [(4, 0, 5), (5, 20, 5)])]
    assert len(packer.open) == 1
    packer.finish()
    assert out[-2:] == [(6, [(6, 0, 8)]), (7, [(6, 8, 1)])] and not packer.open


def test_online_packing_of_an_empty_table(none, odd):
    assert online_packing.op13_windows(none).count() == 0
    with_ids = online_packing.pack_online(odd, keep_ids=True).collect()
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in with_ids)
    with pytest.raises(ValueError):
        online_packing.pack_online(odd, fan_in=1)


def test_byte_encoder_is_the_tokenizer():
    coder = online_packing.encoder(online_packing.default_vocabulary())
    texts = ["", " ", "a\n\n b  c\t d", "don't I'LL 12345 _x_ 　漢字 🙂‍🙂", "<|endoftext|>", "a<|endoftext|>  b", prose(9, 500)]
    texts += [f"a{chr(c)}b 1{chr(c)} .{chr(c)}{chr(c)} x{chr(c)}" for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    for text in texts:
        assert coder.encode(text).tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


# ---------------------------------------------------------------- 4 sampling: nothing is lost


def segmentations(model, unit: str) -> set[tuple[int, ...]]:
    """All ways to write a unit in usable pieces (a character without a piece: its bytes)."""
    found: dict[int, set] = {len(unit): {()}}
    table = {}
    for k, h in enumerate(model.hashes.tolist()):
        if model.ids[k] >= 0:
            table[h] = int(model.ids[k])
    for at in range(len(unit) - 1, -1, -1):
        here = set()
        for end in range(at + 1, min(len(unit), at + model.longest) + 1):
            piece = table.get(model._hash_of(unit[at:end]))
            if piece is not None:
                here |= {(piece, *rest) for rest in found[end]}
        if unit[at] not in model.single:
            here |= {(*[model.bytes[x] for x in unit[at].encode()], *rest) for rest in found[at + 1]}
        found[at] = here
    return found[0]


def test_every_segmentation_is_emitted_when_there_are_few():
    model = sampling.PieceModel(sampling.default_vocabulary())
    texts = ["ab", "in", "er", "he", "the", "a", "漢", "of it", "\n", "on\nan", "ing", " ", "x  y"]
    for text in texts:
        units = sampling.UNIT.findall(model.normalize(text))
        ways = {()}
        for u in units:
            ways = {(*a, *b) for a in ways for b in segmentations(model, u)}
        for k in (max(1, len(ways) - 1), len(ways), len(ways) + 3):
            *found, kappa = sampling.sample_batch(model, np.array([11], np.uint64), [text], k, decode=True)[0]
            ids = [tuple(np.frombuffer(raw, "<u4").tolist()) for raw, *_ in found]
            assert len(set(ids)) == len(ids) == min(k, len(ways)) and set(ids) <= ways, text
            assert (kappa == -math.inf) == (k >= len(ways))
            assert [g for _, _, g, _ in found] == sorted((g for _, _, g, _ in found), reverse=True)
            assert {t for *_, t in found} == {text}
            if k >= len(ways):
                assert sum(math.exp(logp) for _, logp, _, _ in found) == pytest.approx(1.0)


def test_regions_left_for_later_change_nothing():
    """Looking at every region at once gives the same samples; a bound that hides regions is noticed."""
    model = sampling.PieceModel(sampling.default_vocabulary())
    texts = [prose(k, 80) for k in range(6)] + ["in er", "the ab in"]
    keys = sampling._mix(np.arange(len(texts)).astype(np.uint64))
    every = sampling.sample_batch(model, keys, texts, 5, far=-math.inf)
    assert sampling.sample_batch(model, keys, texts, 5) == every
    assert sampling.sample_batch(model, keys, texts, 5, far=-3.0) == every


def test_decoded_text_is_the_vocabularys():
    model = sampling.PieceModel(sampling.default_vocabulary())
    texts = [prose(5, 60), " two  spaces ", "é漢🙂\tx", "a" * 70, "=" * 40 + "-" * 40 + " " * 30]
    for text, (*found, _) in zip(texts, sampling.sample_batch(model, np.arange(5).astype(np.uint64), texts, 3, decode=True), strict=True):
        for raw, _, _, decoded in found:
            assert decoded == model.decode(np.frombuffer(raw, "<u4").tolist()) == text


def test_words_of_any_length_are_sampled():
    model = sampling.PieceModel(sampling.default_vocabulary())
    texts = ["z" * 3000, "qzxj " + "qzxj" * 600, "a" + "🙂" * 400]
    for text, (*found, kappa) in zip(texts, sampling.sample_batch(model, np.arange(3).astype(np.uint64), texts, 4, decode=True),
                                     strict=True):
        assert len({raw for raw, *_ in found}) == 4 - (text[0] == "a") * 2 and {t for *_, t in found} == {text}
        assert [g for _, _, g, _ in found] == sorted((g for _, _, g, _ in found), reverse=True) and found[-1][2] >= kappa


def test_likeliest_ways_are_drawn_as_a_whole(monkeypatch):
    """A unit is walked edge by edge only if it leaves its likeliest way; the work per text falls with that."""
    model = sampling.PieceModel(sampling.default_vocabulary())
    texts = [prose(k, 200) for k in range(20)]
    walked, draw = [], sampling.Lattices.draw
    monkeypatch.setattr(sampling.Lattices, "draw", lambda self, node, r: walked.append(len(node)) or draw(self, node, r))
    sampling.sample_batch(model, sampling._mix(np.arange(20).astype(np.uint64)), texts, 4)
    units = sum(len(sampling.UNIT.findall(model.normalize(t))) for t in texts)
    assert sum(walked) < 2 * units  # of four samples; every edge of the first one alone would be more


def test_units_and_sums_do_not_depend_on_how_they_are_found(monkeypatch):
    model = sampling.PieceModel(sampling.default_vocabulary())
    texts = [prose(k, 60) for k in range(4)] + ["", "\n\n a\n", "▁a▁▁b", "x  y \n", "漢字🙂é 漢字🙂é", "the ab in", " "]
    whole = [model.normalize(t) for t in texts]
    points, first, counts = sampling._units(whole)
    cut = np.split(points, first[1:])
    assert [u.tobytes().decode("utf-32-le") for u in cut] == [u for t in whole for u in sampling.UNIT.findall(t)]
    assert counts.tolist() == [len(sampling.UNIT.findall(t)) for t in whole]
    keys = sampling._mix(np.arange(len(texts)).astype(np.uint64))
    ids = lambda: [[(f[0], f[3]) for f in found] for *found, _ in sampling.sample_batch(model, keys, texts, 5, decode=True)]
    once = ids()
    with monkeypatch.context() as m:  # every unit has the same hash
        m.setattr(sampling.pd, "factorize", lambda x: (np.zeros(len(x), np.int64), None))
        assert ids() == once
    with monkeypatch.context() as m:  # all sums in log space
        m.setattr(sampling, "ROOM", -1e9)
        assert ids() == once
    with monkeypatch.context() as m:  # hardly a unit's likeliest way is short enough to be looked at as a whole
        m.setattr(sampling, "USUAL", 1)
        assert ids() == once


# ---------------------------------------------------------------- 5 lines: copies do not change the result


@pytest.mark.parametrize("copies", [2, 15, 16, 17, 40])
def test_line_dedup_does_not_depend_on_the_number_of_copies(spark, copies):
    l1, l2, l3 = (f"{w} line, long enough to count" for w in ("first", "second", "third"))
    rows = [(1, f"{l1}\n{l2}"), (2, f"{l2}\n{l1}\nown line of document 2")]
    rows += [(2 + k, f"{l2}\n{l1}\nown line of document {2 + k}") for k in range(1, copies)]  # each has a line of its own
    rows += [(100 + k, "yes\nno") for k in range(copies)]  # short and equal
    rows += [(200 + k, f"{l3}\nmiddle {k} of its kind\n{l3}\n{l1}\n{l2}\n{l3}") for k in range(copies)]
    rows += [(300 + k, prose(4, 60)) for k in range(copies)]
    got = {r["doc_id"]: r["text"] for r in lines.delete_common_blocks(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == all_pairs(rows)
    assert [got[100 + k] for k in range(copies)] == ["yes\nno"] + [""] * (copies - 1)
    assert got[1 + copies] == f"own line of document {1 + copies}"


def test_runs_of_lines(spark):
    rows = [(1, p, h) for p, h in enumerate([5, 6, 7, 8, 9])] + [(2, p + 3, h) for p, h in enumerate([6, 7, 8, 9])] + [(3, 0, 6), (3, 2, 7)]
    found = defaultdict(set)
    for r in lines.runs(spark.createDataFrame(rows, "doc_id long, pos int, hash long")).collect():
        found[r["doc_id"]].add(r["run"])
    assert len(found[1]) == 4 + 2 and len(found[2]) == 3 + 1 and len(found[1] & found[2]) == 3 + 1 and 3 not in found


# ---------------------------------------------------------------- 3 HTML: linear in the page


@pytest.mark.parametrize("page,text", [
    ("<div>x " * 100_000, None), ("<h1>x" * 60_000, None), ("<p>" + "<table><h1>y" * 30_000, None),
    ("<i>" * 50_000 + "<li>z" * 50_000, None), ("<a " * 330_000 + '"', ""), ("<body><p>kept</p>" + "<a '" * 250_001, None),
    ('<p>one</p><a ">" ' * 60_000 + "'", None), ("</script " * 110_000, ""), ("<script>" + "</script " * 110_000, ""),
    ("<div>" * 50_000 + "</b>" * 200_000, ""), ("<" * 1_000_000, "<" * 1_000_000), ("a<b " * 250_000, None),
    ("&amp;" * 200_000, "&" * 200_000), ("<!--" * 250_000, ""), ("<p class='" + "x y " * 250_000 + "'>t</p>", "t")])
def test_odd_pages_take_linear_time(page, text):
    began = time.process_time()
    got, path, _ = html.extract(page)
    if path:
        html.extract(page, path)
    assert time.process_time() - began < 20
    assert text is None or got == text


def test_a_quote_left_open_hides_no_text():
    page = "<body><article><p>first part</p><p class=x\">second part</p><p title='t'>third part</p></article></body>"
    assert html.extract(page)[0] == "first part\nsecond part\nthird part"
    assert html.extract('<p>a</p><a href="x>b</a><p>c</p>')[0].split("\n")[0] == "a"


def test_the_hosts_path_is_found_again():
    page = "<html><body><div class='c1 main'><p>long text of the page, long enough</p></div><div class='c2 main'><p>more</p></div></body></html>"
    text, path, score = html.extract(page)
    nodes, _ = html.parse(page)
    assert [n.path for n in html.on_path(nodes, path)] == [path] * len(html.on_path(nodes, path)) and path.endswith("div.c.main") and score > 0
    assert {n.order for n in html.on_path(nodes, path)} == {n.order for n in nodes if n.path == path}
    assert html.extract(page, path)[0] == "long text of the page, long enough\nmore" and html.on_path(nodes, "no>such") == []


# ---------------------------------------------------------------- 10 WARC: valid records, foreign packages


def test_records_are_valid_and_unique(spark, tmp_path):
    import gzip

    page = "<p>" + "x" * 1200
    pages = spark.createDataFrame([(1, "http://a.example/x y", page), (2, "http://a.example/", page), (2, "http://a.example/", page),
                                   (3, None, "é"), (None, "odd", None)], "page_id long, url string, html string")
    packages = warc.write_packages(warc.plan_records(pages.coalesce(1)), f"file://{tmp_path}", date="2024-05-06T07:08:09Z")
    seen = set()
    for r in warc.list_records(packages).collect():
        with open(r["path"].removeprefix("file://"), "rb") as f:
            f.seek(r["offset"])
            raw = gzip.decompress(f.read(r["length"]))
        head, block = warc.parse_warc(raw)
        assert raw.endswith(b"\r\n\r\n") and int(head["content-length"]) == len(block) and head["warc-date"] == "2024-05-06T07:08:09Z"
        assert block.startswith(b"HTTP/1.1 200 OK\r\n") and head["content-type"].startswith("application/http")
        if head["warc-type"] == "revisit":
            assert head["warc-refers-to-target-uri"] == "http://a.example/" and block.endswith(b"\r\n\r\n")
        seen.add(head["warc-record-id"])
    assert len(seen) == 5 and all(x.startswith("<urn:uuid:") for x in seen)
    got = Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.read_records(warc.list_records(packages)).collect())
    assert got == Counter({(1, "revisit", 2, 1203): 1, (2, "response", None, 1203): 2, (3, "response", None, 2): 1, (None, "response", None, 0): 1})


def test_foreign_packages_are_read(spark, tmp_path):
    import base64
    import gzip
    import hashlib
    import json

    def record(kind: str, body: bytes, kind_of: str, digest: str | None) -> bytes:
        head = f"WARC/1.0\r\nwarc-type: {kind}\r\nWARC-Target-URI: http://f.example/{kind}\r\nContent-Type: {kind_of}\r\n"
        head += f"WARC-Payload-Digest: {digest}\r\n" if digest else ""
        return (head + f"Content-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"

    page = b"<p>foreign</p>"
    sha = hashlib.sha1(page)
    base32 = "sha1:" + base64.b32encode(sha.digest()).decode()
    plain = [record("warcinfo", b"software: x", "application/warc-fields", None),
             record("response", b"HTTP/1.0 200 OK\r\nServer: s\r\n\r\n" + page, "application/http;msgtype=response", base32),
             record("resource", page, "text/html", None)]
    packed = [gzip.compress(record("revisit", b"", "application/http", base32))]
    lines_, at = ["!OpenWayback-CDXJ 1.0"], 0
    for r in plain:
        lines_.append("example,f)/ 20240101000000 " + json.dumps({"offset": at, "length": len(r), "filename": "one.warc"}))
        at += len(r)
    more = "example,f)/r 20240101000001 " + json.dumps({"offset": "0", "length": str(len(packed[0])), "filename": "two.warc.gz"})
    raw = warc.zip_stored([("datapackage.json", b"{}"), ("archive/one.warc", b"".join(plain)), ("archive/two.warc.gz", packed[0]),
                           ("indexes/a.cdxj", "\n".join(lines_).encode()), ("indexes/b.cdx.gz", gzip.compress(more.encode()))])
    (tmp_path / "f.wacz").write_bytes(raw)
    packages = spark.createDataFrame([(f"file://{tmp_path}/f.wacz",)], "path string")
    got = sorted((r["record_type"], r["url"], r["payload_digest"], bytes(r["payload"] or b"")) for r in
                 warc.read_records(warc.list_records(packages)).collect())
    assert got == [("resource", "http://f.example/resource", sha.hexdigest(), page),
                   ("response", "http://f.example/response", sha.hexdigest(), page), ("revisit", "http://f.example/revisit", sha.hexdigest(), b"")]
    read_at = lambda where, n: raw[where:where + n]
    members = warc.zip_directory(read_at, len(raw))
    with pytest.raises(ValueError):
        warc.indexed_records(read_at, {k: v for k, v in members.items() if k != "archive/one.warc"})
    with pytest.raises(ValueError):
        warc.indexed_records(read_at, {k: v for k, v in members.items() if not k.startswith("indexes/")})
