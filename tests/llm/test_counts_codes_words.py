"""Token counts, vector codes and spelling variants against plain versions, and on odd input."""

import hashlib
import re
import zlib
from collections import Counter
from fractions import Fraction
from math import floor

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer as Loaded

from acreline.llm import spelling, token_cache, walsh_codes
from acreline.llm.common import fresh_dir
from acreline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TEXTS = ["Alpha  beta\n\tgamma", "alpha beta gamma", "ALPHA É é İ Straße", "", None, " ", "<s>hi</s> <|endoftext|>", "a\x00b", "naïve ﬁ 東京 🙂", "word " * 60_000]


def table_of(spark, texts):
    rows = [(None if i == 1 else i, t, "kept", 1) for i, t in enumerate(texts)] + [(0, texts[0], "kept", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, content string, n long")


# --- 11: token counts ------------------------------------------------------------------------


def test_token_query(spark):
    plain = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op11_token_cache"](spark, SF).collect()}
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        n = len(plain.encode(r.text or ""))
        want[r.doc_id] = (len((r.text or "").encode()), n, n > 4096)
    assert got == want


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"])
def test_counts_are_the_library_s(spark, name):
    path = public_tokenizers.path(name)
    if name.endswith(".json"):
        plain = Loaded.from_file(path)
        want = [len(plain.encode(t or "", add_special_tokens=False).ids) for t in TEXTS]
    else:
        plain = sentencepiece.SentencePieceProcessor(model_file=path)
        want = [len(plain.encode(t or "")) for t in TEXTS]
    rows = token_cache.count_tokens(table_of(spark, TEXTS), token_cache.load_tokenizer(path), fresh_dir(spark, "tokens"))
    assert rows.columns == ["doc_id", "text", "content", "n", "n_bytes", "n_tokens"]
    got = Counter((r.text, r.n_bytes, r.n_tokens) for r in rows.collect())
    assert got == Counter((t, len((t or "").encode()), n) for t, n in zip([*TEXTS, TEXTS[0]], [*want, want[0]]))


def test_only_distinct_misses_are_encoded(spark):
    cache, tokenizer = fresh_dir(spark, "tokens"), token_cache.load_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    entries = lambda: spark.read.parquet(cache).groupBy("tokenizer").count().collect()
    docs = table_of(spark, TEXTS)
    token_cache.fill_cache(docs, tokenizer, cache)
    # null, empty and the blank text: two contents; the first two differ in case and blanks only
    assert [r["count"] for r in entries()] == [8]
    token_cache.fill_cache(docs, tokenizer, cache)
    assert [r["count"] for r in entries()] == [8]
    # a stored count is used, not computed again
    false = spark.createDataFrame([("planted",)], "t string").select(token_cache.content_digest(F.col("t"), tokenizer).alias("content"))
    false = false.select("content", F.lit(77).cast("long").alias("n_tokens"), F.lit(tokenizer.digest).alias("tokenizer"))
    false.write.mode("append").partitionBy("tokenizer").parquet(cache)
    more = [(1, "planted"), (2, "new one"), (3, "new one"), (4, None)]
    want, stored = {1: 77, 2: 2, 3: 2, 4: 0}, 9
    for sent, text in ((0, "Yet another"), (100, "A third")):  # misses by a join, then by broadcast
        more, want, stored = [*more, (len(more) + 1, text)], want | {len(more) + 1: 2}, stored + (2 if sent == 0 else 1)
        docs = spark.createDataFrame(more, "doc_id long, text string")
        assert {r.doc_id: r.n_tokens for r in token_cache.count_tokens(docs, tokenizer, cache, sent=sent).collect()} == want
        assert [r["count"] for r in entries()] == [stored]
    # another version of the tokenizer meets none of these counts
    other = token_cache.load_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    assert token_cache.stored(spark, cache, other).count() == 0 and other.digest != tokenizer.digest


def test_token_counts_of_nothing_and_clashes(spark):
    tokenizer = token_cache.load_tokenizer(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table_of(spark, TEXTS)
    assert token_cache.count_tokens(docs.limit(0), tokenizer, fresh_dir(spark, "tokens")).count() == 0
    with pytest.raises(ValueError, match="n_tokens"):
        token_cache.count_tokens(docs.withColumn("N_Tokens", F.lit(1)), tokenizer, fresh_dir(spark, "tokens"))
    with pytest.raises(ValueError, match="no library"):
        token_cache.load_tokenizer(public_tokenizers.path("LICENSES.txt"))


# --- 12: vector codes ------------------------------------------------------------------------


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """rows: (id, label, list of numbers); by loops over all entries, with Python's integers."""
    rows = sorted(((i, lab, [floor(Fraction(x) * 4096) for x in v]) for i, lab, v in rows), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    wide = -(-max((len(r[2]) for r in rows), default=0) // parts)
    cut = []
    for r in rows:
        v = r[2] + [0] * (wide * parts - len(r[2]))
        cut.append([v[p * wide : (p + 1) * wide] for p in range(parts)])
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            mine = [near(c[p], books[p])[1] for c in cut]
            for e in range(len(books[p])):
                own = [c[p] for c, m in zip(cut, mine) if m == e]
                if own:
                    books[p][e] = [sum(column) // len(own) for column in zip(*own)]
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for r, e in zip(rows, errors):
        by_label[r[1]] += e
    return Counter((r[0], "".join(f"{e:02x}" for _, e in f), d, by_label[r[1]]) for r, f, d in zip(rows, found, errors)), sha


def test_code_query(spark):
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, sha = plain_codes(rows)
    got = QUERIES["op12_walsh_codes"](spark, SF).collect()
    assert {r.codebooks_sha256 for r in got} == {sha}
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in got) == want


@pytest.mark.parametrize("width", [1, 2, 3, 5, 8, 13])
@pytest.mark.parametrize("top", [2, 1000, 1 << 40])
def test_nearest_entry(width, top):
    rng = np.random.default_rng(width)
    x, c = rng.integers(-top, top, (300, width)), rng.integers(-top, top, (9, width))
    c[7] = c[2]  # ties
    which, far = walsh_codes.nearest(x, c)
    for row, e, d in zip(x.tolist(), which.tolist(), far.tolist()):
        assert (d, e) == min((sum((a - b) ** 2 for a, b in zip(row, y)), k) for k, y in enumerate(c.tolist()))


def test_walsh_rows_are_orthogonal_and_in_order():
    h = walsh_codes.sequency(16)
    assert (h @ h.T == 16 * np.eye(16, dtype=int)).all()
    assert [(row[1:] != row[:-1]).sum() for row in h] == list(range(16))


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("v", F.lit("kept")).withColumn("code", F.lit("kept"))


def test_codes_of_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    whole = [(3, 1, [0.5, -0.25, 3.0]), (3, 1, [0.5, -0.25, 3.0]), (None, None, [1e-9, -1e-9]), (1, None, []), (2, 1, [9.0] * 9), (7, None, [-0.0001] * 4)]
    bad = [(4, 1, None), (5, 1, [1.0, None]), (6, None, [nan, 1.0]), (8, 1, [1.0, inf]), (9, 1, [-inf])]
    got, books = walsh_codes.compress(vectors(spark, whole + bad), parts=2, entries=3, rounds=2)
    assert got.columns == ["id", "label", "code", "error", "label_error"]
    want, sha = plain_codes(whole, 2, 3, 2)
    assert Counter((r.id, r.code, r.error, r.label_error) for r in got.collect()) == want and books.sha256() == sha
    # large integers go through exact arithmetic
    large = [(1, 1, [3e5, 2.0]), (2, 1, [-3e5, 1.5]), (3, 2, [2.9e5, 0.1]), (4, 2, [-123456.789, 7.0])]
    got, books = walsh_codes.compress(vectors(spark, large), parts=1, entries=2, rounds=3)
    want, sha = plain_codes(large, 1, 2, 3)
    assert Counter((r.id, r.code, r.error, r.label_error) for r in got.collect()) == want and books.sha256() == sha
    with pytest.raises(Exception, match="2\\^50"):
        walsh_codes.compress(vectors(spark, [(1, 1, [1e30])]))
    for rows in (bad, []):
        got, books = walsh_codes.compress(vectors(spark, rows))
        assert got.count() == 0 and books.sha256() == hashlib.sha256(b"").hexdigest()


# --- 13: spelling variants -------------------------------------------------------------------


def plain_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: chr(ord(m.group()) + 32), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(vocabulary):
    near = {w: [] for w in vocabulary}
    names = sorted(vocabulary)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if abs(len(a) - len(b)) <= 1 and is_near(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-vocabulary[x], x), default=None)
        form[w] = best if best is not None and vocabulary[best] >= 5 * vocabulary[w] else None
    out = set()
    for w in names:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, vocabulary[w], len(near[w]), vocabulary.get(form[w])))
    return out


def test_spelling_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {tuple(r) for r in QUERIES["op13_spelling_variants"](spark, SF).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == plain_variants(plain_words(rows))


def test_chains_of_forms_and_slices(spark):
    words = {"straßen": 3000, "strassen": 40, "straßn": 500, "strßn": 90, "straßenn": 7, "aabbcc": 5, "aabcc": 25, "aabbccc": 25, "ünabbcc": 6, "aabbcd": 25, "lonely": 9}
    vocabulary = spark.createDataFrame([(w, n) for w, n in words.items()], "word string, n long").repartition(3)
    want = {frozenset((a, b)) for a in words for b in words if a < b and is_near(a, b)}
    pairs = [frozenset((r.word, r.near)) for r in spelling.near_pairs(vocabulary).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == want
    cut = [frozenset((r.word, r.near)) for r in spelling.near_pairs(vocabulary, most=64, cut=1).collect()]  # a broadcast a block
    assert sorted(map(sorted, cut)) == sorted(map(sorted, pairs))
    chain = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)], "word string, form string")
    assert {r.root for r in spelling.roots(chain).collect()} == {"w9"}


def test_edits_have_the_hashes_of_the_words_they_give():
    words = ["aabbcc", "zÿzzyx", "abcdef"]
    points = spelling._points(words, 6)
    plain = lambda w: int(spelling.word_hashes(spelling._points([w], len(w)))[0])
    row, place, h = spelling.deletions(points)
    made = [(words[r][:p] + words[r][p + 1 :], int(x)) for r, p, x in zip(row, place, h)]
    assert {w for w, _ in made} == {w[:i] + w[i + 1 :] for w in words for i in range(6)} and len(made) == len({w for w, _ in made})
    letters = np.array(sorted({ord(c) for w in words for c in w}), np.uint32)
    for p in range(6):
        row, letter, x = spelling.replacements(points, p, letters)
        made += [(words[r][:p] + chr(letters[k]) + words[r][p + 1 :], int(y)) for r, k, y in zip(row, letter, x)]
    assert all(plain(w) == x for w, x in made)


def test_filter_misses_nothing_and_little_else():
    rng = np.random.default_rng(1)
    inside, outside = rng.integers(0, 1 << 63, 5000, np.uint64), rng.integers(0, 1 << 63, 50_000, np.uint64)
    blocks = spelling.blocks_of(len(inside))
    shard = np.zeros((blocks, 8), np.uint64)
    block, bits = spelling._places(inside, blocks)
    for _ in range(spelling.BITS):
        bit = bits & np.uint64(511)
        np.bitwise_or.at(shard, (block, (bit >> np.uint64(6)).astype(int)), np.uint64(1) << (bit & np.uint64(63)))
        bits = bits >> np.uint64(9)
    assert len(spelling.held(shard, 0, inside, blocks)) == len(inside)
    assert len(spelling.held(shard, 0, outside, blocks)) < 0.01 * len(outside)


def test_spelling_of_odd_texts(spark):
    text = "Letters letterz LETTERS, letters; lettersx À×÷ABCD " * 6
    rows = [(1, text), (1, text), (None, text), (None, None), (2, ""), (3, " \n"), (4, "letters " * 60_000), (5, "a" * 70_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("kept") for c in ("word", "n", "edit", "length")})
    got = {tuple(r) for r in spelling.variants(docs).collect()}
    assert got == plain_variants(plain_words(rows)) and len(got) >= 4
    assert spelling.variants(docs.limit(0)).count() == 0
    assert spelling.variants(docs.filter("doc_id = 2")).count() == 0
