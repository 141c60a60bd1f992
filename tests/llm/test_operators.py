"""Each operator against brute force, and on nulls, empty and long texts, ties, repeats and empty tables."""

import functools
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from acreline.llm import arc_to_warc, decontaminate, line_winnow, merkle, mixing, pairwise_quality, pii_semicrf, ring_shards, simhash_trie, similar_texts, toxicity
from acreline.llm.common import components, fresh_dir
from acreline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LONG = "word " * 60_000
RUN = "One long passage stands here. It has several sentences in it. Each of them is plain and short. The whole has more than thirty words. So it is a run that counts. Nothing else does.\n"
ODD = [
    (1, "Alpha beta gamma delta. Epsilon zeta.", "a"),
    (1, "Alpha beta gamma delta. Epsilon zeta.", "a"),
    (None, "Alpha beta gamma delta. Epsilon zeta.", None),
    (None, None, None),
    (2, "", "b"),
    (3, " \n\t ", "b"),
    (4, LONG, None),
    (5, RUN, "c"),
    (6, "Before. " + RUN + "After.", "c"),
    (7, None, "c"),
]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string")
    # names that operators might like to use themselves
    for c in ("id", "fp", "row", "tokens", "__row", "__place", "g", "digest", "score", "count", "node", "next_"):
        df = df.withColumn(c, F.lit("kept"))
    return df.withColumn("source", F.lit("src1"))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def roots(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


# --- 1: SimHash ------------------------------------------------------------------------------


def test_simhash_query(spark, docs):
    rows = sorted(QUERIES["op1_simhash_near_dedup"](spark, SF).collect())
    texts = sorted((r.doc_id, r.text) for r in docs.collect())
    prints = [plain_simhash(t) for _, t in texts]
    assert [r.fingerprint for r in rows] == [f"{p:016x}" for p in prints]
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    assert [r.component_id for r in rows] == [texts[k][0] for k in roots(len(texts), links)]


@pytest.mark.parametrize("budget,subtrie", [(0, 16_384), (4, 16_384), (4, 20), (9, 50)])
def test_trie_links(spark, budget, subtrie):
    rng = random.Random(budget)
    prints = [rng.getrandbits(64) for _ in range(60)]
    while len(prints) < 400:
        prints.append(rng.choice(prints) ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(8))) & (1 << 64) - 1)
    prints = sorted({p & (1 << 64) - 1 for p in prints} | {0, (1 << 64) - 1})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {r.node: r.root for r in components(simhash_trie.links(df, budget, subtrie)).collect()}
    place = {p: i for i, p in enumerate(signed)}
    want = roots(len(prints), [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= budget])
    mine = roots(len(prints), [(place[a], place[b]) for a, b in got.items()])
    assert mine == want


def test_simhash_odd(odd):
    rows = simhash_trie.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    assert {r.component_id for r in rows if r.simhash == 0} == {2}
    kept = simhash_trie.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 5, 6]
    assert simhash_trie.near_duplicates(odd.limit(0)).count() == 0


def test_one_row_of_each_group_under_equal_ids(spark):
    """An id may carry texts of several groups: each group keeps its own row, whatever the layout."""
    a, b, c = ("one two three four five six", "red green blue black white grey", "north south east west up down")
    rows = [(5, a), (5, b), (3, b), (5, c), (5, c), (None, c), (None, "all alone here with no name"), (None, "all alone here with no name")]
    want = {(5, a), (3, b), (5, c), (None, "all alone here with no name")}
    for parts in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        kept = [tuple(r) for r in simhash_trie.drop_near_duplicates(docs).collect()]
        assert len(kept) == len(want) and set(kept) == want


@pytest.mark.parametrize("chunk", [3, 1024])
def test_near_dedup_stage_by_brute_force(spark, monkeypatch, chunk):
    import corpus_pipeline

    monkeypatch.setattr(similar_texts, "CHUNK", chunk)
    rng, rows = random.Random(8), [(90, "", "x"), (91, None, "x"), (92, "one two", "x"), (None, "one two", "x")]
    for k in range(12):
        words = [f"w{rng.randrange(900)}" for _ in range(rng.choice((30, 120)))]
        for j in range(6):
            new = list(words)
            for at in rng.sample(range(len(new)), j):
                new[at] = "x%d" % rng.randrange(900)
            rows.append((100 + 6 * k + j, " ".join(new), "x"))
    sets = [{tuple((r[1] or "").split()[i : i + 5]) for i in range(max(1, len((r[1] or "").split()) - 4))} for r in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    groups = defaultdict(list)
    for i, r in enumerate(roots(len(rows), pairs)):
        groups[r].append(rows[i][0] if rows[i][0] is not None else 10**9)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()) == sorted(map(min, groups.values()))


def test_forest_of_similar_sets_by_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(30):
        base = [rng.choice(400, rng.integers(1, 60), replace=False) for _ in range(6)]
        sets = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
        for _ in range(60):
            own = base[rng.integers(6)]
            sets.append(np.unique(np.where(rng.random(len(own)) < 0.06, rng.integers(0, 400, len(own)), own)).astype(np.uint64))
        pairs = [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))]
        want = roots(len(sets), pairs)
        assert roots(len(sets), similar_texts.similar_forest(sets)) == want


def test_components_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in components(chain).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and got[101] == 100
    assert components(chain.limit(0)).count() == 0


# --- 2: lines --------------------------------------------------------------------------------


def test_lines_query(spark, docs):
    texts = dict(sorted((r.doc_id, r.text) for r in docs.collect()))
    cut = dict(zip(texts, ({k: np.array(v) for k, v in r.items() if k in "h words g p".split()} for r in line_winnow._cut([t or "" for t in texts.values()]).to_pylist())))
    flat = {k: c["h"][line_winnow.squeezed(c["h"])] for k, c in cut.items()}
    first = {}
    for k, c in cut.items():
        for g, p in zip(c["g"].tolist(), c["p"].tolist()):
            first.setdefault(g, (k, p))
    for r in QUERIES["op2_line_winnowing"](spark, SF).collect():
        c, runs, sources = cut[r.doc_id], set(), set()
        for g, p in zip(c["g"].tolist(), c["p"].tolist()):
            k, q = first[g]
            if (k, q) != (r.doc_id, p):
                runs.update(line_winnow.matched_runs(flat[r.doc_id], flat[k], p - q))
        gone = line_winnow.deleted_units(c["h"], c["words"], sorted(runs), line_winnow.MIN_WORDS)
        assert (r.n_units, r.n_deleted) == (len(gone), int(gone.sum()))


def repeated_words(texts, length=51):
    """Places of the words of each text that lie in ``length`` consecutive words which an earlier text has too; and the
    place of each word in code points."""
    seen, out = set(), {}
    for k, text in texts.items():
        spans = [(m.start(), m.end()) for m in re.finditer(r"\S+", text or "")]
        words = [text[a:b] for a, b in spans]
        grams = [hash(tuple(words[i : i + length])) for i in range(len(words) - length + 1)]
        hit = {j for i, g in enumerate(grams) if g in seen for j in range(i, i + length)}
        seen.update(grams)
        out[k] = [spans[j] for j in sorted(hit)]
    return out


def test_repeats_by_words(spark, docs):
    """Against a plain search for 51 words in a row that an earlier document has: most of them have to go, and what goes
    has to stand in an earlier place, unit by unit."""
    texts = dict(sorted((r.doc_id, r.text or "") for r in docs.collect()))
    gone = {r.id: r.deleted for r in line_winnow.find_repeats(docs.select("doc_id", "text")).collect()}
    wanted = [(k, a, b) for k, spans in repeated_words(texts).items() for a, b in spans]
    caught = sum(any(x.start <= a and b <= x.stop for x in gone[k]) for k, a, b in wanted)
    assert len(wanted) > 1_000 and caught >= 0.95 * len(wanted)
    seen = set()
    for k, text in texts.items():
        at = 0
        for unit in plain_units(text):
            if any(x.start <= at and at + len(unit) <= x.stop for x in gone[k]):
                assert tuple(unit.split()) in seen
            seen.add(tuple(unit.split()))
            at += len(unit)


@functools.cache
def plain_hash(word):
    """The hash that says where long sentences are cut, byte by byte."""
    all_, total, power = (1 << 64) - 1, 0, 1
    for byte in word.encode():
        total, power = (total + int(line_winnow._BYTE[byte]) * power) & all_, power * int(line_winnow._BASE) & all_
    x = (total + len(word.encode())) & all_
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & all_
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & all_
    return x ^ (x >> 31)


def plain_units(text):
    """Units one word at a time."""
    out = []
    for sentence in re.findall(r"[^\n.!?]*[.!?]*\s*", text):
        words = sentence.split()
        if len(words) <= line_winnow.WORDS:
            out += [sentence] if sentence else []
            continue
        spaced = re.findall(r"\s*\S+\s*", sentence)
        h, begin = [plain_hash(w) for w in words], 0
        for i in range(len(h)):
            near = h[max(0, i - line_winnow.NEAR) : i] + h[i + 1 : i + 1 + line_winnow.NEAR]
            if h[i] < min(near) or i + 1 - begin == line_winnow.WORDS:
                out.append("".join(spaced[begin : i + 1]))
                begin = i + 1
        out += ["".join(spaced[begin:])] if begin < len(h) else []
    return out


def test_units_and_their_hashes():
    rng = random.Random(5)
    made = [" ".join(rng.choice(["a", "bb", "c\n", "dd.", "  e"]) if rng.random() < 0.2 else "w%d" % rng.randrange(400) for _ in range(rng.randrange(90))) for _ in range(150)]
    many = " ".join("v%d" % rng.randrange(10**6) for _ in range(40))
    blanks = [many.replace(" ", "  ", 1), " " + many, many + " ", many.replace(" ", "\t", 1) + "  ", many.replace(" ", "\u3000", 3), many + "\n" + many.replace(" ", "  ", 1)]
    odd = ["a.b!c? d...e\u3000f\u00a0g\u2028h. \x1ci j\x85k.\n\n  l", "  \n  abc", "  ...abc", ". . a", "é.é ü!ü ", " " * 50, "1.2.3.4 " * 30, " ".join("é%d.ü" % i for i in range(90))]
    rows = ["", " \n ", "one", "...", LONG[:5_000], "x" * 300_000 + " y" * 40, *odd, *blanks, *made]
    cut = line_winnow._cut(rows).to_pylist()
    named = {}
    for text, c in zip(rows, cut):
        parts = plain_units(text)
        assert line_winnow.units(text) == parts
        assert (c["chars"], c["words"]) == (list(map(len, parts)), [len(p.split()) for p in parts])
        for part, h in zip(parts, c["h"]):
            assert named.setdefault(tuple(part.split()), h) == h
    assert len(set(named.values())) == len(named)
    assert [line_winnow._cut([t]).to_pylist()[0] for t in rows] == cut  # texts do not mix


def test_winnowing_finds_every_shared_run():
    rng = np.random.default_rng(2)
    for _ in range(300):
        shared = rng.integers(0, 1 << 62, line_winnow.GRAM)
        a, b = (np.concatenate([rng.integers(0, 1 << 62, rng.integers(0, 9)), shared, rng.integers(0, 1 << 62, rng.integers(0, 9))]) for _ in "ab")
        words = lambda x: np.full(len(x), line_winnow.MIN_WORDS // line_winnow.GRAM)
        g = [set(line_winnow.winnow(x, words(x), np.array([len(x)]))[0].tolist()) for x in (a, b)]
        assert g[0] & g[1]


def test_long_sentences_by_words(spark):
    rng, rows, held = random.Random(6), [], {}
    word = lambda: "v%d" % rng.randrange(10**6)
    for k in range(120):
        shared = [word() for _ in range(60)]
        for j in range(2):
            before, after = ([word() for _ in range(rng.randrange(1, 40))] for _ in "ab")
            rows.append((2 * k + j, " ".join(before + shared + after)))
        start = len(" ".join(before)) + 1
        held[2 * k + 1] = (start, start + len(" ".join(shared)))
    found = line_winnow.find_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    gone = {r.id: r.deleted for r in found}
    half = 0
    for k, (a, b) in held.items():
        assert all(a <= x.start and x.stop <= b + 1 for x in gone[k])  # only words that brute force finds
        half += 2 * sum(x.stop - x.start for x in gone[k]) >= b - a
    assert half >= 0.97 * len(held) and not any(gone[k - 1] for k in held)
    for _ in range(300):
        parts = [np.array([[rng.randrange(1 << 62), rng.randrange(1, 17)] for _ in range(rng.randrange(9))], np.int64).reshape(-1, 2) for _ in range(4)]
        shared = []
        while sum(w for _, w in shared) < line_winnow.MIN_WORDS:
            shared.append([rng.randrange(1 << 62), rng.randrange(1, 17)])
        a, b = (np.concatenate([x, shared, y]).astype(np.int64) for x, y in (parts[:2], parts[2:]))
        g = [set(line_winnow.winnow(x[:, 0].copy(), x[:, 1], np.array([len(x)]))[0].tolist()) for x in (a, b)]
        assert g[0] & g[1]


def test_lines_odd(odd):
    clean = line_winnow.dedup_lines(odd)
    assert clean.columns == odd.columns
    got = defaultdict(list)
    for r in clean.collect():
        got[r.doc_id].append(r.text)
    assert got[5] == [RUN] and got[6] == ["Before. After."] and got[7] == [None] and got[2] == [""] and got[3] == [" \n\t "]
    assert got[1] == [ODD[0][1]] * 2  # a repeat, but too short to count
    assert len(got[4][0].split()) == line_winnow.WORDS  # immediate repeats of one unit
    assert line_winnow.dedup_lines(odd.limit(0)).count() == 0
    assert "".join(line_winnow.units("A b. C!!\n\n d" + LONG)) == "A b. C!!\n\n d" + LONG


# --- 3: personal data ------------------------------------------------------------------------

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text):
            d = [int(c) for c in m.group() if c in "0123456789"]
            double = [sum(divmod(2 * x, 10)) if i % 2 else x for i, x in enumerate(reversed(d))]
            if kind == "ip" and max(map(int, m.group().split("."))) > 255:
                continue
            if kind == "card" and not (16 <= len(d) <= 19 and sum(double) % 10 == 0):
                continue
            if kind == "phone" and not 8 <= len(d) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans_match_the_rules():
    rng = random.Random(3)
    for _ in range(5_000):
        t = "".join(rng.choice("0123456789012345 +().-@a.b\né") for _ in range(rng.randint(0, 60)))
        assert [x for x in pii_semicrf.joined(pii_semicrf.base_spans(t)).split(",") if x] == plain_spans(t)


def test_pii_query(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in QUERIES["op3_pii_semicrf"](spark, SF).collect():
        base = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(",")) | {""}
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in base) for k in RULES]


def test_pii_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    weights = pii_semicrf.fit_pii(docs)
    found = lambda t: pii_semicrf.joined(pii_semicrf.all_spans(t, weights)[1])
    assert found("call (017) 555-7713 now") == "phone:5:19"
    assert found("made on 2024-01-12 at 10:30, part 12345678, page 555") == ""
    n, edges = 3, [(0, 1, "ip", []), (0, 2, "ip", []), (1, 3, "ip", [])]
    score = [0.3, -0.2, 1.1]
    paths = {(): 0.0, (0,): 0.3, (1,): -0.2, (2,): 1.1, (0, 2): 1.4}  # every segmentation of three tokens
    z = sum(np.exp(s) for s in paths.values())
    want = [sum(np.exp(s) for p, s in paths.items() if k in p) / z for k in range(3)]
    assert np.allclose(pii_semicrf._expected(n, edges, score), want)


def test_pii_odd(odd):
    rows = pii_semicrf.find_pii(odd, pii_semicrf.fit_pii(odd)).collect()
    assert len(rows) == len(ODD) and {r.pii.spans for r in rows} == {""}
    assert pii_semicrf.find_pii(odd.limit(0), pii_semicrf.fit_pii(odd.limit(0))).count() == 0
    masked = pii_semicrf.mask_pii(odd.withColumn("text", F.lit("Write to a.b@c.org or +1 (017) 555-7713.")), {})
    assert masked.first().text == "Write to <email> or <phone>."


# --- 4: shards -------------------------------------------------------------------------------


def walk(counts, ring, shards):
    """The clockwise walk, row by row: counts of rows per (home place, shard)."""
    n = sum(counts.values())
    room = [n // shards + (s < n % shards) for s in range(shards)]
    placed, queue = Counter(), []
    for p in sorted(ring):
        s, c = ring[p][1], counts.get(p, 0)
        stay = min(c, room[s])
        room[s] -= stay
        placed[p, s] += stay
        if c > stay:
            queue.append([p, ring[p][0], c - stay])
    queue.sort(key=lambda x: (x[1], x[0]))
    nodes = sorted({(node, s) for node, s in ring.values()})
    for turn in range(2):
        for node, s in nodes:
            for x in queue:
                if x[2] and (turn or x[1] <= node):
                    take = min(x[2], room[s])
                    room[s] -= take
                    x[2] -= take
                    placed[x[0], s] += take
    return {k: v for k, v in placed.items() if v}


@pytest.mark.parametrize("rows,hot,shards", [(500, 0, 7), (500, 200, 7), (3, 0, 5), (900, 600, 4)])
def test_ring_walk(spark, rows, hot, shards):
    docs = spark.range(rows).select(F.when(F.col("id") >= hot, F.col("id")).alias("doc_id"))
    got = ring_shards.assign_shards(docs, shards, vnodes=4).collect()
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert len(got) == rows and all(sorted(x) == list(range(len(x))) for x in by.values())
    sizes = [len(by[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    ring = {r.place: (r.node, r.shard) for r in ring_shards.ring(spark, shards, 4).collect()}
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("\u0000"))
    places = docs.select(F.pmod(F.xxhash64(key, F.lit(4)), F.lit(len(ring))).alias("p")).collect()
    want = walk(Counter(r.p for r in places), ring, shards)
    moved = Counter()
    for (p, s), c in want.items():
        moved[ring[p][1], s] += c
    assert Counter((r.home_shard, r.shard) for r in got) == moved


def test_ring_odd(spark, odd):
    assert ring_shards.assign_shards(odd.limit(0)).count() == 0
    rows = ring_shards.assign_shards(odd, shards=3, vnodes=2)
    assert rows.columns == [*odd.columns, "shard", "slot", "home_shard"] and rows.count() == len(ODD)
    q = QUERIES["op4_ring_shards"](spark, SF)
    assert dict(q.dtypes)["grown_shard"] == "int" and {r.law for r in q.collect()} == {"rows"}


# --- 5: archives -----------------------------------------------------------------------------


def test_archives(spark):
    rows = [(1, "http://a b", "x" * 150), (2, None, "x" * 150), (3, "http://c", "x" * 150), (3, "http://c", "x" * 150)]
    rows += [(4, "u", "\r\n\r\nWARC/1.1\r\n\r\n"), (5, "u", None), (None, "u", "é\n\n"), (6, "u", ""), (8, "u", "x" * 99), (9, "u", "x" * 99)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("archive", F.lit(1)).withColumn("record", F.lit("q"))
    arc, warc = fresh_dir(spark, "arc"), fresh_dir(spark, "warc")
    arc_to_warc.write_arc(pages, arc, version=F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(2)) + 1)
    assert {r.version for r in arc_to_warc.read_arc(spark, arc).collect()} == {1, 2}
    arc_to_warc.convert(spark, arc, warc)
    got = arc_to_warc.read_warc(spark, warc).collect()
    assert not [r.error for r in got if r.error]
    assert len({r.record_id for r in got}) == len(got)
    files = {r.path for r in got}
    assert sorted(r.path for r in got if r.type == "warcinfo") == sorted(files)
    got = [r for r in got if r.type != "warcinfo"]
    of = {r.record_id: r for r in got}
    for r in got:
        if r.type == "revisit":  # refers to a response with its payload, by the identifier that one has
            assert of[r.refers_to_id].type == "response" and of[r.refers_to_id].digest == r.digest and of[r.refers_to_id].key == r.refers_to
    want = sorted((k or -1, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest()) for k, _, h in rows)
    assert sorted((r.key or -1, r.bytes, r.digest) for r in got) == want
    assert sorted((r.key, r.refers_to) for r in got if r.type == "revisit") == [(2, 1), (3, 1), (3, 1)]
    bodies = {r.key: bytes(r.payload) for r in got if r.type == "response"}
    assert bodies[4] == rows[4][2].encode() and bodies[None] == "é\n\n".encode()
    empty = fresh_dir(spark, "arc")
    arc_to_warc.write_arc(pages.limit(0), empty)
    assert arc_to_warc.read_arc(spark, empty).count() == 0


def test_archive_query(spark):
    rows = [(r.page_id, (r.html or "").encode()) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    first = {}
    for k, h in sorted(rows):
        first.setdefault(h, k)
    want = {(k, len(h), hashlib.sha256(h).hexdigest(), *(("response", None) if len(h) < 100 or first[h] == k else ("revisit", first[h]))) for k, h in rows}
    got = QUERIES["op5_arc_to_warc"](spark, SF)
    assert {tuple(r) for r in got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()} == want
    assert got.count() == len(rows) and not got.filter("error IS NOT NULL").count()
    empty = spark.read.parquet(f"{SF}/pages.parquet").limit(0)
    arc, warc = fresh_dir(spark, "arc"), fresh_dir(spark, "warc")
    arc_to_warc.write_arc(empty, arc)
    arc_to_warc.convert(spark, arc, warc)
    assert arc_to_warc.read_warc(spark, warc).count() == 0


def test_records_as_crawlers_wrote_them():
    http = "HTTP/1.0 404 Not Found\r\nServer: x\r\n\r\n"
    block = arc_to_warc.version_block("a.arc", 1, "19990101000000")
    records = [("http://x/", "text/html", http + "gone"), ("dns:x", "text/dns", "19990101000000\nx. 1 IN A 1.2.3.4"), ("http://y/", "no-type", "HTTP/ but no head")]
    data = block + "".join(f"\n{u} 1.2.3.4 19990101000000 {t} {len(b)}\n{b}" for u, t, b in records)
    rows = list(arc_to_warc.parse_arc(data.encode()))
    made = [arc_to_warc.warc_record(row, "a.arc", n, None) for n, row in enumerate(rows)]
    made.append(arc_to_warc.warc_record(rows[0], "b.arc", 7, {"path": "a.arc", "n": 0, "key": None, "url": "http://x/", "date": "1999-01-01T00:00:00Z"}))
    back = list(arc_to_warc.parse_warc("".join(m + arc_to_warc.WARC_END for m in made).encode()))
    assert [r["type"] for r in back] == ["response", "resource", "response", "revisit"] and not any(r["error"] for r in back)
    assert [r["payload"] for r in back] == [b"gone", records[1][2].encode(), records[2][2].encode(), b""]
    assert [r["bytes"] for r in back] == [4, len(records[1][2]), len(records[2][2]), 4]
    assert back[3]["refers_to_id"] == back[0]["record_id"] and len({r["record_id"] for r in back}) == 4
    broken = made[0].replace("gone", "GONE").encode()
    assert list(arc_to_warc.parse_warc(broken))[0]["error"] == "digest"


def test_result_columns_have_to_be_free(spark, odd, docs, labels):
    ranker = pairwise_quality.fit_quality(docs, labels)
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    tree = merkle.fingerprints(odd, F.col("text"), "tree")
    steps = {
        "shard": lambda d: ring_shards.assign_shards(d, 3),
        "slot": lambda d: ring_shards.assign_shards(d, 3),
        "home_shard": lambda d: ring_shards.assign_shards(d, 3),
        "mix": lambda d: mixing.select_mix(d, ("lang",)),
        "contamination": lambda d: decontaminate.find_contamination(d, benchmark),
        "next": lambda d: merkle.with_next(d, "doc_id", ["text"], "text"),
        "tree": lambda d: merkle.fingerprints(d, F.col("text"), "tree"),
        "pii": lambda d: pii_semicrf.find_pii(d, {}),
        "quality": lambda d: pairwise_quality.score_quality(d, ranker, out="quality"),
    }
    for name, step in steps.items():
        with pytest.raises(ValueError, match=name):
            step(odd.withColumn(name.upper(), F.lit(1)))
    # names that are used inside are free to use outside
    mixed = mixing.select_mix(odd.withColumn("l", F.lit("kept")).withColumn("n0", F.lit(1)), ("lang",))
    assert {r.l for r in mixed.collect()} == {"kept"} and "l" in tree.withColumn("l", F.lit(1)).columns


def test_damaged_archive():
    block = arc_to_warc.version_block("a.arc", 1, "20200101000000")
    good = "http://x 0.0.0.0 20200101000000 text/html; charset=utf-8 3\nabc\n"
    rows = list(arc_to_warc.parse_arc((block + "\n" + "broken line\n" + good + "http://y 0.0.0.0 20200101000000 t 999\nab").encode()))
    assert [r["error"] for r in rows] == ["header or length", None, "header or length"]
    assert rows[1]["payload"] == b"abc" and rows[1]["type"] == "text/html; charset=utf-8"
    assert list(arc_to_warc.parse_arc(b"no archive"))[0]["error"] == "no version block"


# --- 6: mixture ------------------------------------------------------------------------------


def test_water_filling(spark):
    rows = [("p", "a", 10, 1, 100), ("p", "b", 500, 1, 100), ("p", "c", 500, 2, 100), ("q", "a", 5, 1, 100)]
    nodes = spark.createDataFrame(rows, "parent string, name string, cap long, weight long, budget long")
    got = {(r.parent, r.name): r.given for r in mixing.share_out(nodes, ["parent"], "name").collect()}
    assert got == {("p", "a"): 10, ("p", "b"): 30, ("p", "c"): 60, ("q", "a"): 5}


def test_mix_odd(odd):
    mixed = mixing.select_mix(odd, ("lang", "source"), share="1/2")
    assert mixed.columns == [*odd.columns, "mix"]
    total = sum(r.n for r in odd.select(mixing.token_count(F.col("text")).alias("n")).collect())
    assert mixed.agg(F.sum(mixing.mix_tokens(F.col("text")))).first()[0] == total // 2
    assert mixing.select_mix(odd.limit(0), ("lang",)).count() == 0
    twice = mixing.select_mix(odd, ("lang",), share="2", max_epochs=2)
    assert twice.agg(F.sum(mixing.mix_tokens(F.col("text")))).first()[0] == 2 * total


@pytest.mark.parametrize("digits", [(0,), (1, 2), mixing.DIGITS, (31, 32)])
def test_prefix_end_at_any_fineness(spark, monkeypatch, digits):
    """However finely the end is looked for, the rows are those of a plain walk in hash order."""
    monkeypatch.setattr(mixing, "DIGITS", digits)
    rows = [(i // 2, "w " * (i % 7), f"s{i % 3}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = Counter((r.doc_id, r.text, r.source, r.n) for r in mixing.select_mix(docs, ("source",), {"source": {"s1": 3}}, "1/3").withColumn("n", mixing.mix_tokens(F.col("text"))).collect())
    size = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in ("s0", "s1", "s2")}
    budget = sum(size.values()) // 3
    given = dict.fromkeys(size, 0)
    share = {s: budget * w / 5 for s, w in (("s0", 1), ("s1", 3), ("s2", 1))}
    want = Counter()
    for s in size:
        given[s] = sum(n for (*_, x, n), k in got.items() if x == s for _ in range(k))
        assert given[s] == size[s] or abs(given[s] - share[s]) <= max(0, share["s1"] - size["s1"]) + 1
        left = given[s]
        mine = sorted((hashlib.md5(f"6:0:{d}".encode()).hexdigest(), t, d) for d, t, x in rows if x == s)
        for _, t, d in mine:
            if left > 0:
                want[d, t, s, min(left, len(t.split()))] += 1
            left -= len(t.split())
    assert sum(given.values()) == budget
    assert got == want


# --- 7: Merkle trees -------------------------------------------------------------------------


def test_merkle_odd(spark, odd):
    rows = merkle.with_next(merkle.fingerprints(odd, F.col("text"), "tree"), "doc_id", ["text", "tree"], tie="text")
    got = rows.select("doc_id", "text", "next.text", merkle.likeness("tree", "next.tree").alias("l")).toDF("k", "t", "n", "l").collect()
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    after = Counter((order[i][0], order[i][1], order[(i + 1) % len(order)][1]) for i in range(len(order)))
    assert Counter((r.k, r.t, r.n) for r in got) == after and all(0 <= r.l <= 1 for r in got)
    assert merkle.with_next(merkle.fingerprints(odd.limit(0), F.col("text"), "tree"), "doc_id", ["tree"], tie="text").count() == 0


def test_merkle_sorts_rows_before_their_trees(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("line. "), F.col("id")).alias("text"))
    grow = lambda rows: merkle.fingerprints(rows, F.col("text"), "tree")
    rows = merkle.with_next(docs, "doc_id", ["text", "tree"], tie="text", prepare=grow, rows_per_range=9)
    sorts = [x for x in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "Sort [" in x]
    assert len(sorts) == 1
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window [") < plan.index("md5(") < plan.index("Sort [")  # top down
    assert {r["doc_id"]: r["t"] for r in rows.select("doc_id", F.col("next.text").alias("t")).collect()} == {i: f"line. {(i + 1) % 40}" for i in range(40)}


def test_merkle_of_blocks_with_equal_short_digests(spark):
    seen, k = {}, 0
    while (short := hashlib.md5(b"block %d" % k).hexdigest()[:8]) not in seen:
        seen[short], k = k, k + 1
    two = spark.createDataFrame([(f"block {seen[short]}", f"block {k}")], "a string, b string")
    two = merkle.fingerprints(merkle.fingerprints(two, F.col("a"), "ta"), F.col("b"), "tb")
    r = two.select(merkle.edits("ta", "tb").alias("e"), merkle.likeness("ta", "tb").alias("l"), "ta.root", "tb.root").toDF("e", "l", "x", "y").first()
    assert r.e == [0] and r.l == 0.0 and r.x != r.y


def test_merkle_ranges_and_edits(spark):
    docs = spark.range(500).select((F.col("id") * 7 % 500).alias("doc_id"), F.col("id").cast("string").alias("text"))
    rows = merkle.with_next(docs, "doc_id", ["doc_id"], tie="text", rows_per_range=9)
    assert all(r.next.doc_id == (r.doc_id + 1) % 500 for r in rows.collect())
    lines = [f"Line number {i} says something." for i in range(30)]
    two = spark.createDataFrame([("\n".join(lines), "\n".join([*lines[:9], "Another.", *lines[10:]]))], "a string, b string")
    two = merkle.fingerprints(merkle.fingerprints(two, F.col("a"), "ta"), F.col("b"), "tb")
    r = two.select(merkle.edits("ta", "tb").alias("e"), merkle.edits("ta", "ta").alias("none"), merkle.likeness("ta", "tb").alias("l")).first()
    assert r.e == [9] and r.none == [] and 0.9 < r.l < 1


# --- 8: toxicity -----------------------------------------------------------------------------


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    chain = toxicity.fit_toxicity(docs, labels.filter(~held))
    rows = toxicity.score_toxicity(docs.select("doc_id", "text"), chain).join(labels.filter(held), "doc_id").collect()
    hit = sum(r.toxic == 1 and r.toxicity.flagged for r in rows)
    assert hit / sum(r.toxic == 1 for r in rows) > 0.7
    assert sum(r.toxic == 0 and r.toxicity.flagged for r in rows) / sum(r.toxic == 0 for r in rows) < 0.02
    assert chain.names == ("toxic", "repeated", "dense") and chain.links[1].earlier[0] > 0  # the chain is used


def test_toxicity_odd(odd, labels):
    rows = toxicity.score_toxicity(odd, toxicity.fit_toxicity(odd, labels.limit(0))).collect()
    assert len(rows) == len(ODD) and all(0 <= r.toxicity.toxic <= 1 for r in rows)


# --- 9: decontamination ----------------------------------------------------------------------


def test_decontamination_odd(spark, odd):
    bench = spark.createDataFrame([("x", "alpha BETA gamma"), ("x", "zeta"), (None, "epsilon"), ("y", None), ("z", "...")], "item_id string, text string")
    for block in (1, 5_000_000):
        rows = decontaminate.find_contamination(odd, bench, block=block).collect()
        by = {(r.doc_id, r.text): r.contamination for r in rows}
        c = by[1, ODD[0][1]]
        assert c.n_words == 6 and [(h.start, h.stop) for h in c.hits] in ([(0, 3), (4, 6)],) and c["items"] == ["x"]
        assert by[None, None].n_words == 0 and by[4, LONG].n_words == 60_000 and len(rows) == len(ODD)
    kept = decontaminate.drop_contaminated(odd, bench)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id) == [2, 3, 4, 5, 6, 7]
    assert decontaminate.find_contamination(odd, bench.limit(0)).count() == len(ODD)
    cut = {r.doc_id: r.text for r in decontaminate.cut_spans(odd.filter("doc_id = 1"), bench).collect()}
    assert cut[1] == " delta. ."


# --- 10: quality -----------------------------------------------------------------------------


def test_quality_held_out(spark):
    rows = QUERIES["op10_pairwise_quality"](spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    rows = [r for r in rows if r.held_out]
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.99
    assert np.mean([g >= 0.3 for g in good]) > 0.98 and np.mean([b >= 0.3 for b in bad]) < 0.1


def test_preferences():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    raw = x @ np.array([2.0, -1.0, 0.0])
    i, j = rng.integers(0, 300, 4_000), rng.integers(0, 300, 4_000)
    wins = rng.random(4_000) < 1 / (1 + np.exp(raw[j] - raw[i]))
    w = pairwise_quality.fit_preferences(x, np.where(wins, i, j), np.where(wins, j, i))
    assert np.allclose(w, [2, -1, 0], atol=0.25)


def test_quality_odd(odd, labels):
    rows = pairwise_quality.score_quality(odd, pairwise_quality.fit_quality(odd, labels), out="quality").collect()
    assert len(rows) == len(ODD) and all(0 <= r.quality <= 1 for r in rows)
    assert len(pairwise_quality.features(b"")) == len(pairwise_quality.FEATURES)
