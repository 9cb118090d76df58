"""Each operator against a plain version of it."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexigrid.llm import bpe, embedding_dedup, line_dedup, packing, quality_rules, secret_scan, simhash_dedup, substring_dedup, toxicity, url_filter
from lexigrid.llm.queries import VOCABULARY
from tests.conftest import DATA
from tests.llm import brute


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").select("doc_id", "text").collect()]


def test_line_dedup(spark, docs):
    found = line_dedup.line_dedup(spark.createDataFrame(docs, "doc_id long, text string"))
    want = brute.line_dedup(spark, docs)
    assert Counter((r["doc_id"], r["text"]) for r in found.collect()) == Counter((i, want[i, t]) for i, t in docs)
    assert any(want[d] != d[1] for d in want)


def test_line_dedup_survives_a_shift(spark):
    r = random.Random(3)
    shared = [f"shared {k} {r.random()}" for k in range(40)]
    a, b = "\n".join(shared), "\n".join(["new first line", *shared])
    out = {x["doc_id"]: x["text"] for x in line_dedup.line_dedup(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")).collect()}
    assert out[1] == a
    assert len(out[2].split("\n")) < 12


@settings(max_examples=15, deadline=None)
@given(st.integers(2, 80), st.integers(1, 40), st.floats(0.3, 0.99), st.integers(0, 9))
def test_embedding_bounds(n, dims, threshold, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)) + rng.choice([0, 3], n)[:, None]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    cos = unit @ unit.T
    want = {(i, j) for i in range(n) for j in range(i + 1, n) if cos[i, j] >= threshold + 1e-9}
    i, j, _ = embedding_dedup.close_pairs(x, None, threshold)
    found = {(int(a), int(b)) for a, b in zip(i, j, strict=True)}
    assert want <= found and all(cos[p] >= threshold - 1e-9 for p in found)


def test_embedding_tiles(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16))
    x = np.concatenate([base, base + rng.normal(scale=0.05, size=base.shape)]).astype(np.float32)
    d = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = {(i, j) for i in range(80) for j in range(i + 1, 80) if unit[i] @ unit[j] >= 0.95}
    assert {(r["a"], r["b"]) for r in embedding_dedup.near_pairs(d, tile=13).collect()} == want and want


@pytest.mark.parametrize("tile", [13, 8192])
def test_embedding_classes(spark, tile):
    """Copies, near copies in chains, and lone vectors; some rows twice."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(12, 16))
    near = np.concatenate([base, *[base[:6] + rng.normal(scale=0.05 * k, size=(6, 16)) for k in (1, 2, 3)], base[:2], base[:2], base[:2]]).astype(np.float32)
    ids = [*range(100, 100 + len(near))]
    x, ids = np.concatenate([near, near[:3]]), [*ids, *ids[:3]]
    d = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<float>").repartition(5)
    want = brute.classes(x, ids, 0.95)
    assert sorted(map(tuple, embedding_dedup.near_classes(d, tile=tile).collect())) == sorted(want)
    assert len({c for _, c, _ in want}) < len(set(ids)) and any(n > 3 for _, _, n in want)


def test_embedding_classes_of_a_large_group(spark):
    """A third of the rows are near copies of one another, all different."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 32))
    x[:300] = x[0] + rng.normal(scale=0.02, size=(300, 32))
    x = x.astype(np.float32)
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = sorted(map(tuple, embedding_dedup.near_classes(d, tile=200).collect()))
    assert found == sorted(brute.classes(x, list(range(900)), 0.95)) and sum(n == 299 for _, _, n in found) == 300


def test_secrets(spark, docs):
    found = Counter((r["doc_id"], r["rule"], r["match_no"]) for r in secret_scan.find_secrets(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    want = Counter((i, r.name, k) for i, t in docs for r in secret_scan.RULES for k, _ in enumerate(re.finditer(r.pattern.encode(), t.encode()), 1))
    assert found == want and want


@pytest.mark.parametrize("pattern", ["ab[cd]e+f", "(?:abc|xyz)+q", "a{3}b?", "[0-9]{4}", "x(?:yz)?w", "(?i)Token[:=]", ".*", "ab|cde", "(?:ab){2,3}c"])
def test_trigram_queries_never_miss(pattern):
    rule = secret_scan.Rule("r", pattern)
    r = random.Random(1)
    texts = ["".join(r.choice("abcdefxyzqwTOKEN:=0123 ") for _ in range(r.randint(0, 14))) for _ in range(4000)] + ["abcee", "abcef", "abdeeef", "abcxyzq", "aaab", "xyzw", "xw", "TOKEN=", "ababc", "abababc", "cde"]
    data = pa.array(texts)
    found = {(row, k) for row, _, k, _, _ in secret_scan.Index((rule,)).matches(*brute.utf8_parts(data))}
    assert found == {(row, k) for row, t in enumerate(texts) for k, _ in enumerate(re.finditer(pattern, t), 1)}


@pytest.mark.parametrize("hot", [2, 50_000])
def test_substrings(spark, docs, hot):
    some = docs[:300] + [(None, "a b c d e f g h"), (7001, "z a b c d e f y"), (7001, "z a b c d e f y"), (7001, "q a b c d e f y"), (7002, "r s t u v " * 30), (7003, "s t u v r " * 20), (None, "a b c d e f g h")]
    d = spark.createDataFrame(some, "doc_id long, text string").repartition(6)
    for window in (5, 50):
        found = Counter(map(tuple, substring_dedup.repeated_intervals(d, window=window, hot_least=hot).collect()))
        assert found == brute.repeated_intervals(spark, some, window)
        assert any(kept for *_, kept in found) and not all(kept for *_, kept in found)


def test_planted_passage_is_caught_whole(spark, docs):
    passage = " ".join(f"planted{k}" for k in range(60))
    some = [*docs[:50], (9001, f"one two {passage} three"), (9002, f"{passage} four")]
    d = spark.createDataFrame(some, "doc_id long, text string")
    found = {tuple(r) for r in substring_dedup.repeated_intervals(d).collect()}
    assert {(9001, 2, 62, True), (9002, 0, 60, False)} <= found
    left = {r["doc_id"]: r["text"] for r in substring_dedup.drop_repeated(d).collect()}
    assert left[9001] == some[50][1] and left[9002] == " four"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab ", max_size=40), max_size=6), st.integers(2, 6))
def test_equal_windows_share_their_anchor(texts, window):
    text, place, hashes, anchors, at = substring_dedup.windows_of(*brute.utf8_parts(pa.array(texts, pa.string())), window)
    words = [t.split() for t in texts]
    grams = [tuple(words[i][p : p + window]) for i, p in zip(text.tolist(), place.tolist(), strict=True)]
    assert [len(g) for g in grams] == [window] * sum(max(0, len(w) - window + 1) for w in words)
    by: dict = {}
    for g, h, a in zip(grams, hashes.tolist(), anchors.tolist(), strict=True):
        assert by.setdefault(g, (h, a)) == (h, a)
    assert len({h for h, _ in by.values()}) == len(by)
    assert all(0 <= x for x in np.diff(at))


def _bins(rows, capacity: int) -> dict[int, int]:
    bins: Counter = Counter()
    for r in rows:
        assert 0 < r["length"] <= capacity
        bins[r["bin_id"]] += r["length"]
    assert max(bins.values(), default=0) <= capacity
    return bins


@pytest.mark.parametrize("capacity", [7, 64, 2048])
def test_packing(spark, capacity):
    r = random.Random(capacity)
    lengths = [(k, r.choice([0, 1, 3, 5, capacity // 2, capacity, capacity + 1, 3 * capacity + 2, r.randint(1, capacity)])) for k in range(3000)]
    d = spark.createDataFrame(lengths, "doc_id long, n long")
    rows = packing.pack(d.withColumn("text", F.lit("")), capacity, length=F.col("n")).collect()
    bins = _bins(rows, capacity)
    assert sorted(bins) == list(range(len(bins)))
    pieces = Counter()
    for x in rows:
        pieces[x["doc_id"]] += x["length"]
        assert x["start"] == x["piece"] * capacity
    assert pieces == Counter({k: n for k, n in lengths if n})
    total = sum(n for _, n in lengths)
    first_fit: list[int] = []
    for x in sorted((x["length"] for x in rows), reverse=True):
        spot = next((i for i, room in enumerate(first_fit) if room >= x), None)
        if spot is None:
            first_fit.append(capacity - x)
        else:
            first_fit[spot] -= x
    assert len(bins) <= max(math.ceil(total / capacity) * 1.05 + 3, len(first_fit) + 2)


def test_configuration_is_the_best():
    rng = np.random.default_rng(2)
    for _ in range(20):
        capacity = int(rng.integers(1, 12))
        prices = np.concatenate([[0], rng.random(capacity) * (rng.random(capacity) < 0.6)])

        def best(room: int, prices=prices, capacity=capacity) -> float:
            return max([0.0, *(prices[s] + best(room - s) for s in range(1, min(room, capacity) + 1) if prices[s] > 0)])

        own = packing.best_configuration(prices, capacity)
        assert sum(s * n for s, n in own) <= capacity
        assert sum(prices[s] * n for s, n in own) == pytest.approx(best(capacity))


def test_simhash(spark, docs):
    ids, texts = [i for i, _ in docs], [t for _, t in docs]
    found = {r["doc_id"]: r["kept_doc_id"] for r in simhash_dedup.removed_pairs(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    roots = brute.near_groups(texts, simhash_dedup.TAU)
    want = {ids[i]: ids[r] for i, r in enumerate(roots) if r != i}
    assert set(found) <= set(want)
    assert len(set(found) & set(want)) >= 0.9 * len(want) and want


def test_fingerprints(docs):
    """Against the definition in plain Python, which the brute force of groups uses."""
    texts = ["", "   ", "a b", "ÀÉ × Ünïcödé 中文 \U0001f600", "Same same SAME", *[t for _, t in docs[:12]]]
    fps, _ = simhash_dedup.fingerprints(*brute.utf8_parts(pa.array(texts)))
    assert [int.from_bytes(f.tobytes(), "little") for f in fps] == [brute.fingerprint(t) for t in texts]
    assert (brute.prints(texts) == fps).all()


def _connected(n: int, pairs) -> np.ndarray:
    label = np.arange(n)
    for a, b in pairs:
        x, y = sorted((label[a], label[b]))
        label[label == y] = x
    return label


def test_simhash_candidates(docs):
    """Of all pairs within the distance at least 0.9 are connected by the edges, which are such pairs or chains of them."""
    texts = [t for _, t in docs]
    want = brute.near_pairs_count(texts, simhash_dedup.TAU)
    fps, keys = simhash_dedup.fingerprints(*brute.utf8_parts(pa.array(texts)))
    order = np.argsort(keys.ravel(), kind="stable")
    nodes = np.repeat(np.arange(len(texts)), keys.shape[1])[order]
    a, b = simhash_dedup.group_edges(keys.ravel()[order].astype(np.int64), nodes, fps[nodes], simhash_dedup.TAU)
    label, whole = _connected(len(texts), zip(a.tolist(), b.tolist(), strict=True)), _connected(len(texts), want)
    assert all(whole[x] == whole[y] for x, y in zip(a.tolist(), b.tolist(), strict=True))
    assert sum(label[x] == label[y] for x, y in want) >= 0.9 * len(want) and want


def test_simhash_hot_buckets_in_blocks(spark, docs):
    """Buckets cut into blocks of 5 fingerprints give the same components."""
    d = spark.createDataFrame(docs[:300], "doc_id long, text string")
    base = d.select("doc_id", F.xxhash64("text").alias("k"), "text")
    prints = base.mapInArrow(simhash_dedup._fingerprint_rows, "doc_id long, k long, fp binary, keys array<int>").cache()
    own = [sorted(map(tuple, simhash_dedup.components(simhash_dedup.near_edges(prints, block_rows=n)).collect())) for n in (5, 1 << 17)]
    assert own[0] == own[1] and own[0]


def test_url_rules(spark):
    pages = spark.read.parquet(f"{DATA}/sf0.01/pages.parquet")
    found = Counter((r["page_id"], r["rule"]) for r in url_filter.url_matches(pages).collect())
    want = Counter((p["page_id"], r.name) for p in pages.collect() for r in url_filter.RULES if re.search(r.pattern, p["url"].lower()))
    assert found == want and want


def test_thousands_of_url_rules(spark):
    """An index of 5,000 rules, some of several tokens, some of none; a table that is too large to broadcast gives the same."""
    r = random.Random(4)
    rules = tuple(url_filter.Rule(f"r{k}", rf"^https?://(?:[^/]*\.)?site{k}\.test/" if k % 3 else rf"/(?:path{k}|way{k})/") for k in range(5000)) + (url_filter.Rule("digits", "[0-9]{6}"),)
    urls = [f"https://www.site{r.randrange(5200)}.test/path{r.randrange(5200)}/way{r.randrange(5200)}/{r.randrange(10**7)}" for _ in range(400)] + ["", None, "http://site1.test/PATH3/way3/"]
    d = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    searches = [(x.name, re.compile(x.pattern).search) for x in rules]  # more than re keeps
    want = Counter((i, name) for i, u in enumerate(urls) if u for name, search in searches if search(u.lower()))
    assert Counter((x["page_id"], x["rule"]) for x in url_filter.url_matches(d, rules).collect()) == want and len(want) > 400
    kept, url_filter.BROADCAST_BYTES = url_filter.BROADCAST_BYTES, 0
    try:
        assert Counter((x["page_id"], x["rule"]) for x in url_filter.url_matches(d, rules).collect()) == want
    finally:
        url_filter.BROADCAST_BYTES = kept
    assert {x["page_id"] for x in url_filter.drop_matching(d, rules).collect()} == set(range(len(urls))) - {i for i, _ in want}


@pytest.mark.parametrize(("pattern", "url", "tokens"), [(r"/wiki/talk:", "http://a/wiki/talk:x", {"wiki", "talk"}), (r"login", "x", set()), (r"/(?:rss|feed)/", "/rss/", {"rss", "feed"}), (r"[0-9]{9}", "1", set())])
def test_required_tokens(pattern, url, tokens):
    assert set().union(*url_filter.required_tokens(pattern)) == tokens


def test_quality_cascade_is_the_plain_rules(spark):
    d = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    kept = {r["doc_id"] for r in quality_rules.quality_filter(d).select("doc_id").collect()}
    assert kept == {r["doc_id"] for r in quality_rules.rejections(d).collect() if not r["rejected_by"]}


def test_quality_order():
    m = [quality_rules.Measured("dear", 1.0, 0.5), quality_rules.Measured("cheap", 0.1, 0.4), quality_rules.Measured("idle", 0.1, 0.0)]
    rules = tuple(quality_rules.Rule(n, None, "") for n in ("dear", "idle", "cheap"))
    assert [r.name for r in quality_rules.ordered(rules, m)] == ["cheap", "dear", "idle"]


def test_toxicity_on_labels_it_has_not_seen(spark):
    """The lexicon and the threshold come from half of the labels; the other half judges."""
    d = spark.read.parquet(f"{DATA}/sf0.1/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/sf0.1/labels.parquet").withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2)))
    said = {r["doc_id"] for r in toxicity.toxic_documents(d, labels.where("half = 0")).collect()}
    held = labels.where("half = 1").collect()
    hit = sum(r["toxic"] == 1 and r["doc_id"] in said for r in held)
    wrong = sum(r["toxic"] == 0 and r["doc_id"] in said for r in held)
    toxic = sum(r["toxic"] == 1 for r in held)
    assert hit >= 0.8 * toxic and wrong <= 0.02 * (len(held) - toxic)


def test_toxicity_is_the_plain_walk(spark):
    """Polarities and scores against the definitions in plain Python, over texts in which toxic words keep company."""
    r = random.Random(11)
    plain = [f"w{k}" for k in range(60)]
    bad = ["idiot", "scum", "vermin", "Trottel"]
    rows, labels = [], {}
    for i in range(700):
        words = [r.choice(plain) for _ in range(r.randint(3, 12))] + ["the", "the"]
        r.shuffle(words)
        if i % 7 == 0:
            words[2:2] = [*r.sample(bad, 4), *r.sample(bad, 3)]
        rows.append((i, " ".join(words)))
        if i % 2 == 0:
            labels[i] = int(i % 7 == 0)
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    told = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    encoded, lexicon = toxicity.induce(d, told)
    own, threshold, floor = toxicity.scored(encoded, lexicon, told)
    polarity, scores = brute.toxicity(rows, labels, floor)
    found = dict(zip(lexicon.hashes.view(np.int64).tolist(), lexicon.weights.tolist(), strict=True))
    assert set(found) == set(polarity) and all(found[h] == pytest.approx(polarity[h], abs=1e-9) for h in found)
    assert max(polarity.values()) > floor and threshold < float("inf")
    own = {x["doc_id"]: x["score"] for x in own.collect()}
    assert all(own[i] == pytest.approx(scores[i], abs=1e-4) for i in scores) and len(own) == len(scores)
    assert {x["doc_id"] for x in toxicity.toxic_documents(d, told).collect()} == {i for i in range(700) if i % 7 == 0}


@pytest.fixture(scope="module")
def codec():
    import base64

    import tiktoken

    blob = open(VOCABULARY, "rb").read()
    merges = bpe.Merges.read(blob)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, blob.splitlines())}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return bpe.Transducer(merges), bpe.Decoder(merges), tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


_PIECES = ["a", " ", "  ", "\n", "'s", "'ll", "'re", "é", "中", "1", "!", "\t", "ver", "un", "ness", "😀", " '", "’", " ", "İ", "ا", "́"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(_PIECES), st.text(max_size=4)), max_size=25))
def test_bpe_is_exact(codec, pieces):
    text = "".join(pieces).encode(errors="ignore").decode()
    t, d, reference = codec
    ids = bpe.encode(t, pa.array([text, None, text + text]))
    want = reference.encode_ordinary(text)
    assert ids.to_pylist() == [want, None, reference.encode_ordinary(text + text)]
    assert d.texts(ids).to_pylist() == [text, None, text + text]


def test_bpe_on_documents(spark, docs, codec):
    _, _, reference = codec
    found = {r["doc_id"]: r for r in bpe.encode_documents(spark.createDataFrame(docs, "doc_id long, text string"), VOCABULARY).collect()}
    for i, t in docs:
        assert found[i]["ids"] == reference.encode_ordinary(t) and found[i]["round_trip"] and found[i]["n_tokens"] == len(found[i]["ids"])


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=40))
def test_stream_of_one_word(codec, raw):
    t, _, reference = codec
    assert list(t.stream(raw)) == reference._encode_single_piece(raw)


def test_stream_emits_early(codec):
    t, _, _ = codec
    longest = int(t.size.max())
    read = 0

    def feed():
        nonlocal read
        for byte in (b"thtionnttionererwhst" * 40)[:600]:
            read += 1
            yield byte

    done = 0
    for token in t.stream(feed()):
        done += int(t.size[token])
        assert read - done <= 2 * longest


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(max_size=6), max_size=8))
def test_stream_decoder(codec, parts):
    t, d, _ = codec
    ids = [t.merges.ranks[bytes([b])] for part in parts for b in part]
    stream = bpe.StreamDecoder(t.merges)
    raw = b"".join(parts)
    want = raw.decode(errors="replace")
    assert "".join([stream.feed([i]) for i in ids]) + stream.finish() == want
    assert d.texts(pa.array([ids, ids], pa.list_(pa.int32()))).to_pylist() == [want, want]


def test_clearing_the_states_changes_nothing(codec):
    t, _, reference = codec
    small = bpe.Transducer(t.merges, max_states=50)
    texts = [f"word{k} thtionwh {k * 7919} anonerst" for k in range(300)]
    for k in range(0, 300, 20):
        assert bpe.encode(small, pa.array(texts[k : k + 20])).to_pylist() == [reference.encode_ordinary(x) for x in texts[k : k + 20]]
