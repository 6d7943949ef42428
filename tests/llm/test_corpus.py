"""The corpus operators against brute force, round trips and odd rows."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from larder.llm import embeddings, html, lines, minimizers, neighbours, packing, quality, sampling, simhash, suffix, warc
from larder.llm.common import connected_components

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()),
                     *[T.StructField(c, T.StringType()) for c in ("fp", "rep", "stat", "shared", "runs", "__text", "__row")]])
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return "\n".join(" ".join(r.choice(WORDS) + str(r.randrange(90)) for _ in range(9)) + "." for _ in range(max(1, n // 9)))


def odd_rows() -> list[tuple]:
    """Nulls everywhere, empty and very long texts, copies, near copies, repeated rows and ids, one text in parts."""
    long, base = prose(1, 40_000), prose(2, 200)
    texts = {1: base, 2: None, 3: "", 4: base, 5: base.replace("alpha", "ALPHA"), 6: long, 7: prose(3, 300) + "\n" + base,
             8: prose(4, 120), 9: base.split("\n", 1)[1] + "\nnew last line of this document here", 10: " \n\t\n ",
             11: "ab" * 300, 12: "é" * 130 + "x" + "é" * 130, 13: "ab" * 300, 14: prose(4, 120) + " tail", 15: "short"}
    rows = [(k, t, "en", None, len(t or "")) for k, t in texts.items()]
    rows += [rows[0], rows[0], (None, base, None, None, None), (None, None, None, None, None), (8, prose(5, 60), "en", "s", 7)]
    return [(*r, "a", "b", "c", None, "e", "f", "g") for r in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def small(spark, table: str, where: str = "true"):
    return spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").where(where)


# ---------------------------------------------------------------- 1 SimHash

def components(fps: list[int], distance: int) -> list[int]:
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance and label[i] != label[j]:
                a, b = min(label[i], label[j]), max(label[i], label[j])
                label = [a if x == b else x for x in label]
    return label


def test_fingerprint_by_hand():
    import xxhash

    for text in ("One two  three\tfour Five", "a b", "ÀB c\x0bd e", "word " * 50):
        words = [w for w in "".join(c.lower() if c.isascii() else c for c in text).replace("\t", " ").replace("\x0b", " ").split(" ") if w]
        shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert simhash.fingerprint(text) & simhash.FULL == want
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


@pytest.mark.parametrize("distance", [0, 3, 5])
def test_links_connect_as_brute_force(spark, distance):
    r = random.Random(distance)
    fps = {0}
    for _ in range(40):
        x = r.getrandbits(64)
        for _ in range(6):
            fps.add(x)
            for _ in range(r.randrange(1, 7)):
                x ^= 1 << r.randrange(64)
    fps = sorted(fps)
    df = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")
    roots = connected_components(simhash.fingerprint_links(df, distance))
    found = {r["node"] & simhash.FULL: r["root"] for r in roots.collect()}
    want = components(fps, distance)
    groups = collections.defaultdict(set)
    for x, w in zip(fps, want, strict=True):
        groups[w].add(found.get(x, simhash._signed(x)))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_long_posting_lists_are_split(spark):
    r = random.Random(7)  # one ball: every list is long
    fps = sorted({r.getrandbits(9) | (r.getrandbits(6) << 40) for _ in range(1500)})
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    roots = connected_components(simhash.fingerprint_links(df, 3, list_rows=256))
    found = {r["node"]: r["root"] for r in roots.collect()}
    want = components(fps, 3)
    assert len({(w, found.get(x, x)) for x, w in zip(fps, want, strict=True)}) == len(set(want))


def test_simhash_components(spark, odd, none):
    rows = simhash.op1_simhash(odd).collect()
    assert len(rows) == odd.count()
    byid = {r["doc_id"]: r for r in rows}
    assert byid[1]["fingerprint"] == byid[5]["fingerprint"] and byid[4]["component_id"] == byid[5]["component_id"] == 1
    assert byid[2]["fingerprint"] == "0" * 16 and byid[10]["component_id"] == 2
    assert simhash.op1_simhash(none).count() == 0
    docs = small(spark, "documents")
    got = simhash.op1_simhash(docs).toPandas().sort_values("doc_id")
    want = components([int(x, 16) for x in got["fingerprint"]], 3)
    least = pd.Series(got["doc_id"].to_numpy()).groupby(want).transform("min")
    assert (least.to_numpy() == got["component_id"].to_numpy()).all()


# ---------------------------------------------------------------- 2 packing

def check_places(rows: list, capacity: int) -> int:
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_packing(spark, odd, none):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_vocabulary())
    rows = packing.pack_documents(odd, capacity=128, keep_ids=True).collect()
    check_places(rows, 128)
    got = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["doc_id"] or -1, r["piece"])):
        got[r["doc_id"]].append(np.frombuffer(r["ids"], "<u4").tolist())
    for doc_id in (2, 3, 5, 7, 12):
        text = {r[0]: r[1] for r in odd_rows()}[doc_id]
        assert sum(got[doc_id], []) == t.encode(text or "", add_special_tokens=False).ids + [1]
    assert packing.op2_packing(none).count() == 0


def test_word_encoder_is_the_tokenizer():
    coder = packing.WordEncoder(packing.default_vocabulary())
    for text in ("It's DON'T we'll 12a3 ½ x²", "Ünï çödé ñandú “quoted” – dash…", "a <|endoftext|> b", "İstanbul ΣΑΣ 漢字 🙂",
                 "tab\there\x0b\x0c nb\xa0sp", "''s '' 's -'s", "'" * 9 + "ve"):
        assert coder.encode(text) == coder._whole(text), text
    coder.MEMO_WORDS = 3
    for k in range(30):
        assert coder.encode(f"word{k} word{k + 1} again") == coder._whole(f"word{k} word{k + 1} again")


@pytest.mark.parametrize("seed", range(5))
def test_packing_plan(seed):
    r = random.Random(seed)
    histogram = collections.Counter(r.choice([r.randrange(1, 257), r.randrange(1, 20), 256, 128]) for _ in range(2000))
    runs, sequences = packing.plan_packing(dict(histogram), 256)
    fill, ranks = collections.defaultdict(list), collections.defaultdict(set)
    ends = {(a, f): min([x[1] for x in runs if x[0] == a and x[1] > f], default=histogram[a]) for a, f, *_ in runs}
    for a, first, per, base, offset in runs:
        for k in range(ends[a, first] - first):
            ranks[a].add(first + k)
            fill[base + k // per].append((offset + k % per * a, a))
    assert all(len(ranks[a]) == n for a, n in histogram.items()) and len(fill) == sequences
    for places in fill.values():
        places.sort()
        assert [p for p, _ in places] == np.cumsum([0] + [a for _, a in places])[:-1].tolist()
        assert sum(a for _, a in places) <= 256
    assert sequences <= -(-sum(a * n for a, n in histogram.items()) // 256) + 2


# ---------------------------------------------------------------- 3 HTML

PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
<nav><a href=x>Home</a></nav><div class="cookie-notice">We use cookies</div><div id="content"><div class="post-%d"><h2>Head
&amp; line</h2><p>First   <b>bold</b> and <a href=q>link</a>.<p>Second &eacute; &#x41;<ul><li>one<li>two</ul>
<aside>see also</aside><div class="adSlot">buy</div><form><input>Subscribe</form><!-- no --></div>
<section class="reader-comments"><p>Reader: a very long comment about this nice article, longer than it</p></section></div>
<div class="sidebar"><p>Other</p></div><footer>(c)</footer><script>if(a<b){x("</p>")}</script>"""


def test_html_main_text(spark):
    rows = [(k, f"https://Site.org/{k}", PAGE % k) for k in range(5)]
    rows += [(90, None, None), (91, "odd", ""), (92, "https://site.org/x", "plain words"), (None, "https://site.org/", PAGE % 7),
             (93, "https://site.org/y", "<p>a<p>b <!-- cut"), (4, "https://Site.org/4", PAGE % 4)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, path string")
    got = {r["page_id"]: r for r in html.op3_html(pages).collect()}
    want = "Head & line\nFirst bold and link.\nSecond é A\none\ntwo"
    assert got[0]["text"] == got[4]["text"] == got[None]["text"] == want and got[0]["n_chars"] == len(want)
    assert got[90]["text"] == got[91]["text"] == "" and got[92]["text"] == "plain words" and got[93]["text"] == "a\nb"
    assert html.op3_html(pages).count() == len(rows) and html.op3_html(pages.limit(0)).count() == 0


def test_host_path_wins_over_a_page():
    path = html.extract(PAGE % 1)[1]
    odd = "<html><body><div id='content'><div class='post-3'><p>short</p></div><div class='x'><p>" + "much longer text " * 9 + "</p></div></div></body></html>"
    assert html.extract(odd, path)[0] == "short" and "much longer" in html.extract(odd)[0]


def test_hidden_is_an_attribute():
    text = "Some words of an article, enough of them."
    for how in ('style="overflow:hidden"', 'class="overflow-hidden"', 'aria-hidden="false"', 'hidden="until-found"', "data-x='hidden'"):
        assert html.extract(f"<body><div {how}><article><p>{text}</p></article></div></body>")[0] == text, how
    for how in ("hidden", 'HIDDEN=""', "class=a hidden", "aria-hidden=true", "style='color:red; display : none'"):
        assert html.extract(f"<body><div><p>{text}</p><p {how}>gone</p></div></body>")[0] == text, how
    assert html.extract("<body><div><p>See <a href='/hidden-gems'>gems</a> for more of the same.</p></div>")[0] == "See gems for more of the same."


def test_wrappers_named_as_boilerplate():
    text = "Some words of an article, quite enough of them to be the longest here."
    side = "<p>Tagline</p><div class='sidebar'><p>Other posts</p></div>"
    for how in ("class='content-sidebar-wrap'", "class='page-with-sidebar'", "class='layout-sidebar-right'", "id='search-results'"):
        for inner in (f"<article><p>{text}</p></article>", f"<div class='a'><p>{text}</p></div>", f"<p>{text}</p>"):
            assert html.extract(f"<body><p>Site</p><div {how}>{inner}{side if '<p>T' not in inner else ''}</div></body>")[0].split("\n")[0] == text, how
            assert "Other posts" not in html.extract(f"<body><div {how}>{inner}{side}</div></body>")[0]
    page = f"<body><div class='site'><p>A short line of the site.</p><div class='with-x sidebar-layout'><article><p>{text}</p></article></div></div></body>"
    assert text in html.extract(page, "html>body>div.site")[0] and text in html.extract(page, "body>div.site")[0]
    long = "a reader says much. " * 12  # more than the article: it stays out
    page = f"<body><article><p>{text}</p><section id='comments'><article><p>{long}</p></article></section></article></body>"
    assert html.extract(page)[0] == text


# ---------------------------------------------------------------- 4 sampling

def test_sampling_has_the_right_distribution():
    model = sampling.PieceModel(sampling.default_vocabulary())
    n = 20_000
    keys = sampling._mix(np.arange(n).astype(np.uint64))
    first, pair, logp = collections.Counter(), collections.Counter(), {}
    for *found, kappa in sampling.sample_batch(model, keys, ["hello a"] * n, 3):
        assert len({f[0] for f in found}) == len(found) == 3
        assert found[0][2] >= found[1][2] >= found[2][2] >= kappa
        first[found[0][0]] += 1
        pair[found[0][0], found[1][0]] += 1
        logp |= {f[0]: f[1] for f in found}
    p = {k: math.exp(v) for k, v in logp.items()}
    assert abs(sum(p.values()) - 1) < 1e-3
    for k, v in p.items():
        assert abs(first[k] / n - v) < 0.015
    for (a, b), v in pair.items():
        assert abs(v / n - p[a] * p[b] / (1 - p[a])) < 0.015


def test_sampling_round_trip(spark, odd, none):
    texts = {r[0]: r[1] for r in odd_rows() if r[0] not in (None, 8)}
    rows = sampling.decode_ids(sampling.sample_segmentations(odd, k=3)).collect()
    by = collections.defaultdict(list)
    for r in rows:
        if r["doc_id"] in texts:
            assert r["decoded"] == (texts[r["doc_id"]] or "")
            by[r["doc_id"]].append((r["sample"], bytes(r["ids"]), r["perturbed"]))
    assert all(len({x[1] for x in v}) == len({x[0] for x in v}) for v in by.values())
    assert len(by[2]) == len(by[3]) == 1 and len({x[1] for x in by[1]}) == 3  # doc 1 stands there three times
    again = {(r["doc_id"], r["sample"]): r["ids_crc32"] for r in sampling.op4_sampling(odd.repartition(7)).collect()}
    assert all(again[r["doc_id"], r["sample"]] == r["ids_crc32"] for r in rows if r["doc_id"] in texts and r["sample"] < 2)
    assert sampling.op4_sampling(none).count() == 0


def test_sampling_query_returns_ids_and_texts(spark, odd):
    texts = {r[0]: r[1] for r in odd_rows() if r[0] not in (None, 8)}
    rows = [r for r in sampling.op4_sampling(odd).collect() if r["doc_id"] in texts]
    assert {r["doc_id"] for r in rows} == set(texts) and max(r["sample"] for r in rows) == sampling.K - 1 >= 3
    assert all(r["decoded"] == (texts[r["doc_id"]] or "") and len(r["ids"]) == 4 * r["n_ids"]
               and zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)
    kept = {r["doc_id"]: r["text"] for r in lines.op5_lines(odd).where("doc_id in (4, 9)").collect()}
    assert kept == {4: "", 9: "new last line of this document here"}


def test_runs_of_spaces_have_their_pieces():
    model = sampling.PieceModel(sampling.default_vocabulary())
    sp, text = model.processor, "x    y"
    own = np.array(sp.encode(text), "<u4").tobytes()
    runs = [i for i in range(sp.get_piece_size()) if len(sp.id_to_piece(i)) > 1 and not sp.id_to_piece(i).strip(sampling.MARK)]
    assert runs and set(runs) <= set(model.ids.tolist()) and set(sp.encode(text)) & set(runs)
    *found, _ = sampling.sample_batch(model, np.array([5], np.uint64), [text], 500)[0]
    assert own in {f[0] for f in found} and all(sp.decode(np.frombuffer(f[0], "<u4").tolist()) == text for f in found)


# ---------------------------------------------------------------- 5 lines

def test_aligned_blocks():
    pairs = [(0, 5, True), (1, 6, False), (2, 7, False), (4, 1, True), (5, 2, True), (7, 9, False)]
    assert lines.aligned_blocks(pairs) == [(0, 2)]  # the crossing block is shorter; 7-9 has no rare line
    assert lines.aligned_blocks([]) == []


def test_line_dedup(spark, odd, none):
    out = lines.delete_common_blocks(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    got = {r["doc_id"]: r for r in out.collect()}
    base = prose(2, 200)
    assert got[1]["text"] == base and got[2]["text"] is None and got[4]["text"] == ""
    assert got[7]["text"] == prose(3, 300) and got[9]["text"] == "new last line of this document here"
    assert got[10]["text"] == " \n\t\n " and got[None] is not None and got[6]["n_chars"] == len(got[6]["text"])
    kept = [r["text"] for r in out.where("doc_id is null").collect()]
    assert base in kept
    assert sorted(r["n_deleted"] for r in lines.op5_lines(odd).where("doc_id = 1").collect()) == [0, 0, 0]
    assert lines.op5_lines(none).count() == 0


def test_each_rare_line_stays_once(spark):
    docs = small(spark, "documents")
    before = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    after = [(r["doc_id"], r["text"]) for r in lines.delete_common_blocks(docs).collect()]
    every = lambda rows: {x.strip() for _, t in rows for x in (t or "").split("\n") if x.strip()}
    assert every(before) == every(after)
    first = {}
    for k, t in sorted(before):
        for _, h, _ in lines.line_hashes(t or ""):
            first.setdefault(h, k)
    assert {k for k, t in after if t != dict(before)[k]} <= {k for k, t in before if any(
        first[h] < k for _, h, _ in lines.line_hashes(t or ""))}


def all_pairs(rows: list[tuple[int, str]]) -> dict[int, str]:
    """Each document without the blocks that patience diff aligns with any earlier one, all lines taken as rare."""
    out = {}
    for k, text in rows:
        mine, gone = list(lines.line_hashes(text)), set()
        for e, other in rows:
            place = {h: p for p, (_, h, _) in enumerate(lines.line_hashes(other))}
            if e < k:
                for a, b in lines.aligned_blocks([(p, place[h], 1) for p, (_, h, _) in enumerate(mine) if h in place]):
                    gone.update(mine[p][0] for p in range(a, b + 1))
        out[k] = "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone)
    return out


def test_line_partners_as_all_pairs(spark):
    l1, l2 = "first line, long enough to count", "second line, long enough to count"
    rows = [(1, f"{l1}\n{l2}"), (2, f"{l2}\n{l1}\nshort"), (3, f"{l2}\n{l1}\nshort")]
    r, pool = random.Random(7), [prose(k, 9) for k in range(100, 130)]
    rows += [(k, "\n".join(r.sample(pool, 8))) for k in range(4, 16)]
    rows += [(k, "\n".join(rows[k % 5 + 6][1].split("\n")[:6] + [f"own line of {k}"])) for k in range(16, 22)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in lines.delete_common_blocks(docs, rare_docs=30).collect()}
    assert got == all_pairs(rows) and got[3] == ""
    few = {r["doc_id"]: r["text"] for r in lines.delete_common_blocks(docs, rare_docs=1).collect()}  # by owners alone
    assert few[3] == "" and all(set(got[k].split("\n")) <= set(few[k].split("\n")) | {""} for k in got)


def test_short_lines_are_evidence(spark):
    verse = "\n".join(f"verse {k}" for k in range(6))
    rows = [(k, verse) for k in range(1, 4)] + [(4, "other\nverse 0\nend"), (5, "verse 3\nlone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = lambda n: {r["doc_id"]: r["text"] for r in lines.delete_common_blocks(docs, rare_docs=n).collect()}
    assert kept(16) == {1: verse, 2: "", 3: "", 4: "other\nend", 5: "lone"}
    assert kept(1) == {1: verse, 2: "", 3: "", 4: "other\nverse 0\nend", 5: "verse 3\nlone"}  # common: a run counts, one does not


# ---------------------------------------------------------------- 6 repeated strings

def brute_repeats(rows: list[tuple[int, str]], w: int = 100) -> dict[int, tuple]:
    seen, out = set(), {}
    for k, t in sorted(rows):
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - w + 1):
            if raw[i:i + w] in seen:
                gone[i:i + w] = True
            seen.add(raw[i:i + w])
        spans = int(np.diff(np.concatenate(([0], gone.astype(int)))).clip(0).sum())
        out[k] = (len(raw), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def test_suffix_array_and_prefixes():
    r = random.Random(1)
    raw = bytes(r.choice(b"ab") for _ in range(500)) + b"xyz" * 200 + bytes(r.choice(b"ab") for _ in range(300)) * 2
    buf = np.frombuffer(raw, np.uint8)
    sa = suffix.suffix_array(buf)
    assert sorted(sa.tolist()) == list(range(len(raw)))
    assert all(raw[a:a + 128] <= raw[b:b + 128] for a, b in zip(sa[:-1].tolist(), sa[1:].tolist(), strict=True))
    common = lambda a, b: next((k for k in range(100) if raw[a + k:a + k + 1] != raw[b + k:b + k + 1] or a + k >= len(raw)), 100)
    lcp = suffix.common_prefixes(buf, sa)
    for k in range(1, len(sa)):
        want = common(int(sa[k - 1]), int(sa[k]))
        assert min(100, int(lcp[k])) == want


def test_minimizer_runs_cover_all_windows(monkeypatch):
    monkeypatch.setattr(minimizers, "BLOCK", 1000)
    r = random.Random(3)
    texts = [bytes(r.choice(b"abc ") for _ in range(n)) for n in (50, 100, 101, 999, 3500, 130)] + [b"ab" * 700]
    seen = collections.defaultdict(set)
    for number, low, high in minimizers.blocks_of(np.array([len(t) for t in texts])):
        raw = b"".join(texts[k][a:b] for k, a, b in zip(number, low, high, strict=True))
        assert len(raw) <= 1000
        ends = np.cumsum(high - low)
        gram, at, first, last = minimizers.runs_of(np.frombuffer(raw, np.uint8), ends)
        for g, p, a, b in zip(gram, at, first, last, strict=True):
            k = int(np.searchsorted(ends, a, "right"))
            assert a <= p <= b + 68 and b + 100 <= ends[k]
            for s in range(a, b + 1):
                seen[int(number[k])].add(int(s - (ends[k] - (high - low)[k]) + low[k]))
    for k, t in enumerate(texts):
        assert seen[k] == set(range(max(0, len(t) - 99)))


@pytest.mark.parametrize("shard", [2 << 20, 700])
def test_repeats_as_brute_force(spark, monkeypatch, shard):
    whole = suffix._shard_repeats
    monkeypatch.setattr(suffix, "_shard_repeats", lambda s: whole(s, shard))
    r = random.Random(5)
    passage = prose(9, 60)
    rows = [(k, prose(100 + k % 12, 40)[:r.randrange(150, 400)] + passage[r.randrange(90):][:r.randrange(80, 300)] + prose(k, 20)
             + "é" * (k % 3)) for k in range(70)] + [(80, "ab" * 300), (81, "x" + "ab" * 300), (82, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix.op6_suffix(docs).collect()}
    assert got == brute_repeats(rows)


def test_hot_grams_go_by_windows(spark, monkeypatch):
    r = random.Random(3)
    letters = lambda n: "".join(r.choice("abcdefgh") for _ in range(n))
    common, ends = letters(50), [letters(60) for _ in range(4)]
    rows = [(k, letters(40 + k % 7) + r.choice(ends) + common + r.choice(ends) + letters(30)) for k in range(40)]
    rows += [(k, letters(60) + common + letters(60)) for k in range(40, 60)]
    docs, calls, sharded = spark.createDataFrame(rows, "doc_id long, text string").repartition(5), [], []
    by_windows, by_shards = suffix._window_repeats, suffix._shard_repeats
    monkeypatch.setattr(suffix, "HOT_SEGMENTS", 10)
    monkeypatch.setattr(suffix, "_window_repeats", lambda w: calls.append(w.count()) or by_windows(w))
    monkeypatch.setattr(suffix, "_shard_repeats", lambda s: sharded.append(
        s.groupBy("gram").count().agg(F.max("count")).first()[0] or 0) or by_shards(s))
    got = {x["doc_id"]: (x["n_removed"], x["kept_sha256"]) for x in suffix.op6_suffix(docs).collect()}
    gone = 0
    seen: set[str] = set()
    for k, text in rows:
        cover = [False] * len(text)
        for a in range(len(text) - 99):
            if text[a:a + 100] in seen:
                cover[a:a + 100] = [True] * 100
            seen.add(text[a:a + 100])
        kept = "".join(c for c, x in zip(text, cover, strict=True) if not x)
        assert got[k] == (sum(cover), hashlib.sha256(kept.encode()).hexdigest())
        gone += sum(cover)
    assert gone and calls[0] > 0 and sharded[0] <= 10  # no task gets a gram of more segments


def test_repeats_of_odd_rows(spark, odd, none):
    rows = [(r[0], r[1] or "") for r in odd_rows() if r[0] is not None and r[0] != 8]
    want = brute_repeats(list(dict(rows).items()))
    got = suffix.op6_suffix(odd).where("doc_id <> 8").collect()
    assert all(tuple(r)[1:] == want[r["doc_id"]] for r in got if r["doc_id"] not in (14,)) and len(got) == len(rows)
    assert suffix.op6_suffix(odd).where("doc_id is null and n_removed > 0").count() == 0
    out = suffix.remove_repeats(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert out.where("doc_id = 2 and text is null").count() == 1
    assert out.where("text is not null and n_chars <> length(text)").count() == 0
    assert suffix.op6_suffix(none).count() == 0 and suffix.remove_repeats(none).count() == 0


# ---------------------------------------------------------------- 7 and 8 embeddings

VECTORS = "vec_id long, embedding array<float>, label int, rep string, key string"


def odd_vectors() -> list[tuple]:
    r = np.random.Generator(np.random.PCG64(3))
    rows, k = [], 1
    for label in (0, 1):
        for _ in range(30):
            center = r.standard_normal(20)
            for _ in range(6):
                rows.append((k * 10, (center + 0.18 * r.standard_normal(20)).astype(np.float32).tolist(), label))
                k += 1
    rows += [(5000 + i, rows[0][1], 0) for i in range(40)] + [(6000, rows[0][1], 1), (6001, rows[0][1], None), rows[3]]
    rows += [(7000, None, 0), (7001, [], 0), (7002, [0.0] * 20, 0), (7003, [float("nan")] * 20, 0), (7004, [None] * 20, 0),
             (7005, [float("inf")] * 20, 0), (7006, [1.0, 2.0], 0), (7007, [2.0, 4.0], 0), (None, rows[0][1], 0)]
    return [(*x, "a", "b") for x in rows]


def good(v) -> bool:
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_embedding_links(spark):
    rows = odd_vectors()
    df = spark.createDataFrame(rows, VECTORS)
    usable = [(i, np.array(v, float), lab) for i, v, lab, *_ in rows if i is not None and lab is not None and good(v)]
    label = list(range(len(usable)))
    links = [0] * len(usable)
    for i, (_, u, a) in enumerate(usable):
        for j, (_, v, b) in enumerate(usable):
            if i != j and a == b and len(u) == len(v) and u @ v / math.sqrt((u @ u) * (v @ v)) >= 0.93:
                links[i] += 1
                if label[i] != label[j]:
                    x, y = sorted((label[i], label[j]))
                    label = [x if z == y else z for z in label]
    least = {}
    for (i, *_), x in zip(usable, label, strict=True):
        least[x] = min(least.get(x, i), i)
    want = collections.Counter((i, n, least[x], i == least[x]) for (i, *_), n, x in zip(usable, links, label, strict=True))
    for size in ({}, {"box_rows": 20, "tile_rows": 16}):
        got = embeddings.embedding_near_duplicates(df, **size).collect()
        assert len(got) == len(rows)
        ids = {i for i, *_ in usable}
        assert collections.Counter(tuple(r) for r in got if r["vec_id"] in ids) == want
        rest = [tuple(r) for r in got if r["vec_id"] not in ids]
        assert all(n == 0 and c == i and kept for i, n, c, kept in rest)
    assert embeddings.op7_embeddings(df.limit(0)).count() == 0


def test_neighbours(spark):
    rows = [r for r in odd_vectors()]
    df = spark.createDataFrame(rows, VECTORS)
    usable = {(i, tuple(v)) for i, v, *_ in rows if i is not None and good(v)}
    got = collections.defaultdict(list)
    for r in neighbours.op8_neighbours(df).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for i, v in usable:
        if i % 100:
            assert i not in got
            continue
        want = sorted((math.sqrt(((np.array(v) - np.array(w)) ** 2).sum()), j) for j, w in usable if j != i and len(v) == len(w))[:10]
        found = sorted(got[i])
        assert [x[0] for x in found] == list(range(1, len(found) + 1)) and [(x[2], x[1]) for x in found] == sorted((x[2], x[1]) for x in found)
        hits += len({j for _, j in want} & {x[1] for x in found})
        total += len(want)
    assert hits / total >= 0.9
    assert neighbours.op8_neighbours(df.limit(0)).count() == 0
    doubles = df.withColumn("embedding", F.col("embedding").cast("array<double>"))
    assert neighbours.op8_neighbours(doubles).count() == sum(map(len, got.values()))


def test_recall_on_the_table(spark):
    df = small(spark, "embeddings")
    pdf = df.toPandas()
    v, ids = np.stack(pdf["embedding"]).astype(float), pdf["vec_id"].to_numpy()
    got = neighbours.op8_neighbours(df).toPandas()
    hits = total = 0
    for i in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((v - v[i]) ** 2).sum(axis=1))
        d[i] = np.inf
        want = ids[np.lexsort((ids, d))[:10]]
        hits += len(set(want) & set(got[got["query_id"] == ids[i]]["vec_id"]))
        total += 10
    assert hits / total >= 0.9


def test_chi_square():
    assert abs(neighbours.chi_square_quantile(0.95, 10) - 18.307) < 1e-3
    assert abs(neighbours.chi_square_quantile(0.5, 2) - 2 * math.log(2)) < 1e-9


# ---------------------------------------------------------------- 9 quality

def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    good_, bad = (got[got["quality"] == q]["score"].to_numpy() for q in (1, 0))
    assert np.mean([(good_ > b).mean() + 0.5 * (good_ == b).mean() for b in bad]) > 0.95
    assert (got[got["quality"] == 1]["predicted"] == 1).mean() > 0.98


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (1, None, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.quality_scores(odd, labels).collect()
    assert len(got) == odd.count() and all(r["score"] == 1.0 and r["predicted"] == 1 for r in got)
    assert quality.keep_quality(odd, labels.limit(0)).columns == odd.columns
    assert {r["score"] for r in quality.quality_scores(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(none, labels).count() == 0


def test_kept_rows_are_scored_by_stored_statistics(spark):
    docs = small(spark, "documents")
    kept = quality.keep_quality(docs, small(spark, "labels"))
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan and "regexp" not in plan.lower()
    scores = quality.quality_scores(docs, small(spark, "labels")).where(f"score >= {quality.THRESHOLD}")
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in scores.select("doc_id").collect())


def test_rules_are_columns(spark):
    model = quality.RuleModel(0.5, [(((0, 1.0, None),), 2.0), (((0, None, 3.0), (2, 0.1, 0.9)), -1.5)])
    df = quality.with_statistics(spark.createDataFrame([("Ab cd",), (None,)], "text string")).select(model.score().alias("s"))
    want = [1 / (1 + math.exp(-(0.5 + 2.0 - 1.5))), 1 / (1 + math.exp(-0.5))]
    assert [r["s"] for r in df.collect()] == pytest.approx(want)


# ---------------------------------------------------------------- 10 WARC

@pytest.mark.parametrize("zip64", [False, True])
def test_zip_is_a_zip(tmp_path, zip64):
    import io
    import zipfile

    members = [("a/b.txt", b"hello" * 99), ("index", b""), ("é", bytes(range(256)))]
    raw = warc.zip_stored(members, zip64)
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        assert z.testzip() is None and {n: z.read(n) for n in z.namelist()} == dict(members)
    found = warc.zip_directory(lambda at, n: raw[at:at + n], len(raw))
    assert {n: raw[a:a + k] for n, (a, k) in found.items()} == dict(members)
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x", b"hello" * 99)
    with pytest.raises(ValueError):
        warc.zip_directory(lambda at, n: packed.getvalue()[at:at + n], len(packed.getvalue()))


def test_warc_round_trip(spark, tmp_path):
    big, odd_text = "x" * 1000, "é\r\n\r\nWARC/1.1\r\n" * 90
    rows = [(1, "u1", big), (5, None, big), (3, "u\r\n3", big), (5, "u5", big), (None, "n", big), (2, "u2", "x" * 999),
            (4, "u4", "x" * 999), (6, "u6", None), (7, "u7", ""), (8, "u8", odd_text), (2**60 + 1, "u9", odd_text)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    got = warc.round_trip(spark, pages, f"file://{tmp_path}", payload=True).collect()
    assert len(got) == len(rows)
    kinds = collections.Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got)
    assert kinds[1, "revisit", 5] == kinds[3, "revisit", 5] == kinds[8, "revisit", 2**60 + 1] == 1
    assert kinds[5, "response", None] == 2 and kinds[None, "response", None] == 1
    for r in got:
        text = next(h or "" for i, _, h in rows if i == r["page_id"])
        assert r["payload_bytes"] == len(text.encode()) and r["payload_digest"] == hashlib.sha1(text.encode()).hexdigest()
        if r["record_type"] == "response":
            assert bytes(r["payload"]).decode() == text
    assert warc.op10_warc(pages.limit(0)).count() == 0


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages(spark):
    docs = small(spark, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs.count(), stage(spark, docs, "/root/testdata/sf0.001").cache()
        assert docs.columns == columns and 0 < docs.count() <= before, name
        assert docs.where("n_chars <> length(text)").count() == 0
    left = simhash.op1_simhash(docs.select("doc_id", "text"))
    assert left.count() == docs.select("doc_id").distinct().count()
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert check_places(rows, 4096) == -(-sum(r["length"] for r in rows) // 4096)


def test_pipeline_keeps_odd_rows(spark, odd, none):
    out = corpus_pipeline.dedup_near(spark, odd, "")
    assert out.columns == odd.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert ids.count(1) == 1 and 4 not in ids and 5 not in ids and ids.count(None) == 2 and ids.count(8) == 2
    assert corpus_pipeline.dedup_near(spark, none, "").count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(0, 300)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5, 5)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long").repartition(9)).collect()}
    assert all(got[k] == 0 for k in range(301)) and all(got[1000 + k] == 1000 for k in range(200)) and len(got) == 501
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
