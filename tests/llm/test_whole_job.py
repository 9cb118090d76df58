"""Cases in which an operator once did less than the whole job."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from lexigrid.llm import line_dedup, simhash_dedup, toxicity, url_filter
from lexigrid.llm import queries as q
from tests.conftest import DATA


def without_repeated_runs(spark, rows: list[tuple], least: int = 2) -> dict[tuple, str]:
    """(doc_id, text) to the text without the lines of maximal runs of at least this many lines that occur before; in plain Python."""
    from tests.llm.brute import hashes_of

    docs = {(i, t) for i, t in rows if t is not None}
    whole = hashes_of(spark, [t for _, t in docs])
    seen: dict[str, list[tuple[list[str], int]]] = {}
    out = {}
    for i, t in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, whole[d[1]])):
        lines, gone = t.split("\n"), set()
        for k, line in enumerate(lines):
            for other, j in seen.get(line, []):
                n = 0
                while k + n < len(lines) and j + n < len(other) and lines[k + n] == other[j + n]:
                    n += 1
                if n >= least:
                    gone.update(range(k, k + n))
            seen.setdefault(line, []).append((lines, k))
        out[i, t] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


@pytest.mark.parametrize("n", [2, 3, 4, 6, 10, 20])
def test_op1_removes_short_passages_whole(spark, n):
    r = random.Random(n)
    passage = [f"shared {k} {r.random()}" for k in range(n)]
    own = [[f"own {k} {r.random()}" for k in range(8)] for _ in range(30)]
    rows = [(d, "\n".join([*x[:3], *passage, *x[3:]])) for d, x in enumerate(own)]
    out = {x["doc_id"]: x["text"] for x in line_dedup.run_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {d: rows[0][1] if d == 0 else "\n".join(x) for d, x in enumerate(own)}


def test_op1_finds_all_maximal_runs(spark):
    r = random.Random(1)
    rows = [(d % 70 or None, "\n".join(r.choice("abcdefghijklmnopqrst") + r.choice("xyz") for _ in range(r.randint(0, 12)))) for d in range(90)]
    rows += [(200, "aa\naa\naa\nbb"), (201, "\n\n\n"), (202, None), (202, ""), (203, rows[0][1]), (203, rows[0][1])]
    want = without_repeated_runs(spark, rows)
    found = line_dedup.run_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(map(tuple, found.collect())) == Counter((i, None if t is None else want[i, t]) for i, t in rows)


def test_op1_query_on_documents(spark):
    rows = [(x["doc_id"], x["text"]) for x in spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    want = without_repeated_runs(spark, rows)
    found = q.op1_line_dedup(spark, f"{DATA}/sf0.01").select("doc_id", "text")
    assert Counter(map(tuple, found.collect())) == Counter((i, want[i, t]) for i, t in rows)


def test_op1_exact_copies_go_whole(spark):
    """Lines of one-line chunks went nowhere: copies kept a residue of them."""
    r = random.Random(7)
    own = [[f"line {k} {r.random()}" for k in range(r.randint(2, 30))] for _ in range(40)]
    rows = [(100 * c + d, "\n".join(x)) for c in range(3) for d, x in enumerate(own)]
    out = {x["doc_id"]: x["text"] for x in line_dedup.run_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {i: t if i < 100 else "" for i, t in rows}


UNWANTED = [
    "http://m.casino-win.example.com/en/4033.html", "https://royalcasino.test/", "https://free-bets.example.com/en/5462#top", "http://poker.test:8080/x", "https://cheap-pills.example.com/de/1", "https://buy-meds.test?x=1",
    "https://www.ads-track.example.com/en/9823", "http://click-tracker.test", "https://spam-farm.example.com/fr/907?utm_source=feed", "HTTPS://Link-Farms.test/", "https://adult-x.example.net/1", "http://freeporn.test/a", "https://user@bet.test/",
]
CLEAN = [
    "http://www.example.com/casino/bets?ref=poker", "https://m.example.org/?utm_source=ads", "https://alphabets.test/", "https://specialist.test/", "https://adult-education.test/", "https://anti-spam.test/", "https://tracking.post.test/",
    "http://farm.test/free-bets.html", "https://cheap-flights.test/", "https://downloads.test/#ads", "https://betty.test/", "http://www.essex.test/", "https://sex-education.test/", "https://leads.test/pills", "",
]


def test_op7_tells_unwanted_hosts(spark):
    pages = spark.createDataFrame([(k, u) for k, u in enumerate([*UNWANTED, *CLEAN])] + [(-1, None)], "page_id long, url string")
    named = {r.name for r in url_filter.UNWANTED}
    found = {r["page_id"] for r in url_filter.url_matches(pages).collect() if r["rule"] in named}
    assert found == set(range(len(UNWANTED)))
    assert {r["page_id"] for r in url_filter.drop_unwanted(pages).collect()} == {-1, *range(len(UNWANTED), len(UNWANTED) + len(CLEAN))}
    assert all(url_filter.required_tokens(r.pattern) for r in url_filter.UNWANTED if not r.name.endswith("_name"))


def test_op7_on_pages(spark):
    """Hosts of sf0.1 that a reader would drop, and no other."""
    import re

    pages = spark.read.parquet(f"{DATA}/sf0.1/pages.parquet").select("page_id", "url")
    named = {r.name for r in url_filter.UNWANTED}
    found = {r["page_id"] for r in q.op7_url_filter(spark, f"{DATA}/sf0.1").collect() if r["rule"] in named}
    hosts = re.compile(r"https?://(?:www\.|m\.|blog\.)?(?:casino-win|free-bets|cheap-pills|ads-track|spam-farm|adult-x)\.example\.")
    assert found == {p["page_id"] for p in pages.collect() if hosts.match(p["url"])} and found


def _plain(r: random.Random, k: int) -> str:
    return " ".join(f"w{r.randint(0, 999)}" for _ in range(k))


def test_op8_finds_toxic_texts_of_rare_terms(spark):
    """The term is in 8 of 40,000 texts, 0.02 %; 7 of them are labelled."""
    r = random.Random(5)
    rare = [(k, f"{_plain(r, 4)} grobian {_plain(r, 4)}") for k in range(8)]
    rows = [*rare, *((100 + k, _plain(r, 9)) for k in range(39992))]
    r.shuffle(rows)
    labels = spark.createDataFrame([*((k, 1) for k in range(7)), *((100 + k, 0) for k in range(3000))], "doc_id long, toxic int")
    found = toxicity.toxic_documents(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), labels)
    assert {x["doc_id"] for x in found.collect()} == set(range(8))


def test_op8_finds_many_toxic_texts(spark):
    """A hot source: the labelled toxic texts 20 times over, so that their terms are in more than a tenth of all texts."""
    from pyspark.sql import functions as F

    d = spark.read.parquet(f"{DATA}/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{DATA}/sf0.1/labels.parquet")
    hot = d.join(labels.where("toxic = 1").select("doc_id"), "doc_id").crossJoin(spark.range(1, 21)).select((F.col("doc_id") + 1000000 * F.col("id")).alias("doc_id"), "text")
    said = {x["doc_id"] for x in toxicity.toxic_documents(d.unionByName(hot), labels).collect()}
    toxic = {x["doc_id"] for x in labels.where("toxic = 1").collect()}
    clean = {x["doc_id"] for x in labels.where("toxic = 0").collect()}
    assert len(said & toxic) >= 0.7 * len(toxic) and len(said & clean) <= 0.02 * len(clean)
    assert sum(x >= 1000000 for x in said) >= 0.7 * 20 * len(toxic)


def test_op8_lexicon_does_not_depend_on_the_layout(spark):
    d = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{DATA}/sf0.01/labels.parquet")
    found = []
    for laid in (d.coalesce(1), d.repartitionByRange(8, "text")):
        _, lexicon = toxicity.induce(laid, labels, 0.01)
        found.append({int(h): round(float(w), 4) for h, w in zip(lexicon.hashes, lexicon.weights, strict=True) if w})
    assert found[0] == found[1] and found[0]


def _noisy(r: np.random.Generator, fp: np.ndarray, bits: int) -> np.ndarray:
    out = np.unpackbits(fp.view(np.uint8))
    out[r.choice(len(out), bits, replace=False)] ^= 1
    return np.packbits(out).view(np.uint16)


@pytest.mark.parametrize("limits", [{}, {"LARGE_GROUP": 1, "TOLD_APART": 1}])
def test_op6_probes_find_all_pairs(monkeypatch, limits):
    """Tiles that are probed give the components of all pairs within the distance, chains and large buckets included."""
    for name, value in {"EXHAUSTIVE": 0, **limits}.items():
        monkeypatch.setattr(simhash_dedup, name, value)
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 16, (300, 16)).astype(np.uint16)
    fps = np.concatenate([base, [_noisy(r, x, int(r.integers(36, 45))) for x in base], [_noisy(r, base[0], k % 30) for k in range(100)]])
    fps = fps[r.permutation(len(fps))]
    apart = np.bitwise_count(fps[:, None] ^ fps[None]).sum(axis=2)
    for second in (np.zeros(len(fps), bool), r.random(len(fps)) < 0.5):
        i, j = np.nonzero((apart <= simhash_dedup.TAU) & ((second[:, None] != second[None]) | (not second.any())))
        want, own = np.arange(len(fps)), np.arange(len(fps))
        simhash_dedup.joined(want, i, j)
        a, b = simhash_dedup.tile_edges(np.arange(len(fps)), fps, second, simhash_dedup.TAU)
        simhash_dedup.joined(own, a, b)
        if second.any() and limits:  # large buckets also connect within a tile
            whole = np.arange(len(fps))
            simhash_dedup.joined(whole, *np.nonzero(apart <= simhash_dedup.TAU))
            assert (own[i] == own[j]).all() and (whole[a] == whole[b]).all()
        else:
            assert (own == want).all() and (want != np.arange(len(fps))).sum() > 100


def _far_copies(seed: int) -> list[tuple[int, str]]:
    """60 texts and for each a copy, with other words in it, whose fingerprint is 36 to 40 bits from it."""
    from tests.llm import brute

    r = random.Random(seed)
    out = []
    for d in range(60):
        words = [f"word{r.randint(0, 99999)}" for _ in range(60)]
        fp = np.frombuffer(brute.fast_fingerprint(" ".join(words)), np.uint16)
        while True:
            other = [f"other{r.randint(0, 99999)}" if r.random() < 0.06 else w for w in words]
            if 36 <= np.bitwise_count(fp ^ np.frombuffer(brute.fast_fingerprint(" ".join(other)), np.uint16)).sum() <= 40:
                break
        out += [(d, " ".join(words)), (1000 + d, " ".join(other))]
    return out


def test_op6_finds_the_farthest_near_copies(spark):
    """No segment of theirs need be equal: buckets of equal segments, and of one bit flipped, left some out."""
    docs = spark.createDataFrame(_far_copies(2), "doc_id long, text string")
    assert sorted(map(tuple, simhash_dedup.removed_pairs(docs).collect())) == [(1000 + d, d) for d in range(60)]


def test_pipeline_drops_the_farthest_near_copies(spark):
    import corpus_pipeline

    docs = spark.createDataFrame(_far_copies(4), "doc_id long, text string")
    assert sorted(x["doc_id"] for x in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == list(range(60))


def test_op8_nodes_are_all_terms(spark):
    """No label tells of the company of toxic words, which is in a tenth of the texts, nor of terms in one text of all."""
    from tests.llm import brute

    r = random.Random(13)
    rows = []
    for i in range(1000):
        words = [f"w{r.randint(0, 59)}" for _ in range(8)]
        if i % 5 == 0:
            words[2:2] = ["idiot", "scum", *(["company"] if i % 2 else [])]
        rows.append((i, " ".join([*words, *([f"rare{i}"] if i % 100 == 0 else [])])))
    labels = {i: int(i % 5 == 0) for i in range(0, 1000, 2)}
    told = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    _, lexicon = toxicity.induce(spark.createDataFrame(rows, "doc_id long, text string"), told)
    polarity, _ = brute.toxicity(rows, labels, 0.5)
    found = dict(zip(lexicon.hashes.view(np.int64).tolist(), lexicon.weights.tolist(), strict=True))
    assert len(found) == len({w for _, t in rows for w in t.split()}) and set(found) == set(polarity)
    assert all(found[h] == pytest.approx(polarity[h], abs=1e-9) for h in found)


@pytest.mark.parametrize("held", [0, 1 << 23])
def test_op8_counts_all_pairs_in_turns(monkeypatch, held):
    """Pairs go through packing by blocks, in some turns, and come back whole: counts of over 255, far steps, all blocks."""
    import pyarrow as pa

    monkeypatch.setattr(toxicity, "HELD_PAIRS", held)
    monkeypatch.setattr(toxicity, "HELD", 10)
    r, size = np.random.default_rng(6), 1 << 27
    texts = [np.minimum(r.zipf(1.2, int(r.integers(0, 60))), size - 1).astype(np.int32) for _ in range(1500)] + [np.array([3, 7] * 300, np.int32), np.array([0, size - 1, 5000], np.int32)]
    want: Counter = Counter()
    for t in (t.tolist() for t in texts):
        want.update((min(a, b), max(a, b)) for k, a in enumerate(t) for b in t[k + 1 : k + 1 + toxicity.WINDOW] if a != b)
    batch = pa.RecordBatch.from_arrays([pa.array([t.tobytes() for t in texts], pa.binary())], ["seq"])
    found: Counter = Counter()
    for turn in range(toxicity.SLICES):
        packed = pa.Table.from_batches(toxicity._pairs(size, toxicity.WINDOW, turn)(iter([batch]))).combine_chunks().sort_by("block")
        for out in toxicity._merged(size, 1)(iter(packed.to_batches(max_chunksize=7))):
            found.update(dict(zip(zip(out.column("a").to_pylist(), out.column("b").to_pylist(), strict=True), out.column("n").to_pylist(), strict=True)))
    assert found == want and max(want.values()) > 255
    small = pa.RecordBatch.from_arrays([pa.array([(t % 9000).astype(np.int32).tobytes() for t in texts[:50]], pa.binary())], ["seq"])
    whole = sum(sum(1 for k, a in enumerate(t) for b in t[k + 1 : k + 1 + toxicity.WINDOW] if a != b) for t in ((x % 9000).tolist() for x in texts[:50]))
    assert sum(sum(out.column("n").to_pylist()) for out in toxicity._margins(9000, toxicity.WINDOW)(iter([small]))) == 2 * whole


def test_op8_keeps_little_on_disk(spark):
    """All pairs of all texts lay on the disk at once, eight bytes a step, and stayed there."""
    import time

    r = np.random.default_rng(8)
    rows = [(i, " ".join(f"w{k}" for k in r.zipf(1.3, 200) % 30000) + (" idiot scum" if i % 10 == 0 else "")) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).localCheckpoint()
    told = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(0, 4000, 2)], "doc_id long, toxic int").localCheckpoint()
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> dict[str, int]:
        files = manager.getAllFiles()
        return {f.getName(): f.length() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}

    before = shuffled()
    _, lexicon = toxicity.induce(docs, told)
    assert lexicon.weights.any()
    for _ in range(20):
        left = sum(n for name, n in shuffled().items() if name not in before)
        if left < 10000:
            break
        time.sleep(0.5)
    assert left < 10000


def test_op8_tells_toxic_words_from_company_of_high_polarity(spark):
    """In a large graph words that clean texts have too come to 0.9 to 0.97; a floor of 0.9 at most found texts by these."""
    r = np.random.default_rng(14)
    polarity = np.concatenate([np.linspace(0.975, 0.996, 40), np.linspace(0.9, 0.97, 300), np.zeros(2000)])
    rows = []
    for i in range(2000):
        toxic = r.integers(0, 40, 2) if i % 10 == 0 else []
        seq = np.concatenate([toxic, r.integers(40, 340, int(r.integers(0, 9))), r.integers(340, 2340, 40)]).astype(np.int32)
        rows.append((i, bytearray(seq.tobytes()), len(seq)))
    encoded = spark.createDataFrame(rows, "doc_id long, seq binary, size int")
    told = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(0, 2000, 5)], "doc_id long, toxic int")
    scores, threshold, floor = toxicity.scored(encoded, toxicity.Lexicon(np.arange(len(polarity), dtype=np.uint64), polarity), told)
    assert {x["doc_id"] for x in scores.where(f"score >= {threshold}").collect()} == set(range(0, 2000, 10)) and floor > 0.9


def test_op8_floors_follow_the_highest_polarities():
    assert toxicity.floors_of(np.zeros(5)) == toxicity.FLOORS == toxicity.floors_of(np.empty(0))
    found = toxicity.floors_of(np.array([0.97, -0.99, 0.99, 0.95, 0.91, 0.2]))
    assert found == (0.98, 0.96, 0.93, *toxicity.FLOORS)
    assert toxicity.floors_of(np.full(100, 0.95)) == (0.95, *toxicity.FLOORS)
