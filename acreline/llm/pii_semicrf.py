"""Personal data by a semi-Markov conditional random field over whole spans.

Four kinds: e-mail addresses, IP addresses, card numbers, phone numbers. Strict rules find the base
spans, which always stay. The model adds spans that the rules miss, such as a phone number without its
country code. It scores candidate segments as a whole (digit counts, grouping, check digit, what stands
on either side), up to ``LONGEST`` tokens; one dynamic programme per stretch of text chooses
boundaries and kinds together. A segment has to beat leaving its tokens alone by ``MARGIN``.

A stretch is what lies within ``REACH`` characters of a digit or an @ outside base spans. Elsewhere no
segment can be a candidate, so the rest of a text costs one scan and the whole text is searched.

Training maximises the likelihood of the base spans in stretches from a bounded sample of documents
(``DOCUMENTS``, ``STRETCHES``, in hash order), by forward-backward over the candidate segments. Copies of
phone stretches without the country code are added, so that the model learns to do without it.

Defined results: a null text is an empty text and has no spans; very long texts are searched whole;
repeated rows are judged one by one; without any digit or @ in the sample the model adds nothing; an
empty table gives an empty table; all columns stay.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreline.llm.common import claim, texts

KINDS = ("email", "ip", "card", "phone")
DOCUMENTS, STRETCHES, EPOCHS = 10_000, 1_500, 12
REACH, LONGEST, MARGIN = 48, 24, 3.0
RIDGE, RATE = 1e-3, 0.3

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANCHOR = re.compile(r"[0-9@]+")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|.", re.DOTALL)
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int]


def _luhn(digits: str) -> bool:
    odd, even = map(int, digits[-1::-2]), digits[-2::-2]
    return (sum(odd) + sum(int(d) * 2 - 9 * (d > "4") for d in even)) % 10 == 0


def _digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def _emails(t: str) -> Iterator[Span]:
    last, at = 0, t.find("@")
    while at >= 0:
        start = last + len(t[last:at].rstrip(_LOCAL))
        host = _HOST.match(t, at + 1) if start < at else None
        last = at + 1
        if host:
            yield start, host.end()
            last = host.end()
        at = t.find("@", last)


def base_spans(t: str) -> dict[str, list[Span]]:
    """Leftmost spans of each kind; what fails its check is dropped without another try."""
    small = lambda p: len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255
    out = {"email": list(_emails(t)), "ip": [], "card": [], "phone": []}
    if not _DIGIT.search(t):
        return out
    out["ip"] = [m.span() for m in _IP.finditer(t) if all(map(small, m.group().split(".")))]
    for m in _CARD.finditer(t):
        if m.end() - m.start() >= 16:
            d = _digits(m.group())
            if 16 <= len(d) <= 19 and _luhn(d):
                out["card"].append(m.span())
    out["phone"] = [m.span() for m in _PHONE.finditer(t) if 8 <= len(_digits(m.group())) <= 15]
    return out


# --- candidates and features -----------------------------------------------------------------


def _candidate(kind: str, s: str) -> bool:
    """Whether a segment may be of a kind at all; all features are for segments that may."""
    if kind == "email":
        return s.count("@") == 1 and s[0] != "@" and s[-1].isalnum() and "." in s[s.index("@") :] and not re.search(r"\s", s)
    d = len(_digits(s))
    if kind == "ip":
        return s.count(".") == 3 and d >= 4 and bool(re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", s))
    if kind == "card":
        return 13 <= d <= 19 and bool(re.fullmatch(r"[0-9](?:[ -]?[0-9])+", s))
    return 7 <= d <= 15 and s[0] in "+(0123456789" and s[-1].isdigit() and bool(re.fullmatch(r"[+0-9 ().-]+", s)) and "+" not in s[1:]


def features(kind: str, t: str, a: int, b: int) -> list[str]:
    s, left, right = t[a:b], t[a - 1 : a], t[b : b + 1]
    out = ["any"]
    if left.isalnum() or left in ("+", "@", "-", "."):
        out.append("left goes on")
    if right.isalnum() or right in ("@", "-") or (right == "." and t[b + 1 : b + 2].isalnum()):
        out.append("right goes on")
    d = _digits(s)
    if kind == "email":
        host = s[s.index("@") + 1 :]
        out.append("short top level" if re.search(r"\.[A-Za-z]{2,8}$", host) else "odd top level")
    elif kind == "ip":
        out.append("parts fit" if all(len(p) <= 3 and int(p) <= 255 for p in s.split(".")) else "parts too large")
    elif kind == "card":
        out += [f"{len(d)} digits", "check digit fits" if _luhn(d) else "check digit fails"]
        out.append("groups of four" if re.fullmatch(r"[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}", s) else "other groups" if len(d) < len(s) else "one group")
    else:
        groups = re.findall(r"[0-9]+", s)
        out += ["country code" if s[0] == "+" else "no country code", f"{min(len(groups), 5)} groups", f"{min(len(d), 12)} digits"]
        if re.search(r"\([0-9]{2,5}\)", s):
            out.append("area in brackets")
        if s.count("(") != s.count(")"):
            out.append("open bracket")
        if re.search(r"[0-9]{3}-[0-9]{4}$", s):
            out.append("three-four ending")
        if _IP.fullmatch(s) or "." in s:
            out.append("dots")
    return [f"{kind}: {x}" for x in out]


Edge = tuple[int, int, str, list[str]]


def lattice(t: str) -> tuple[list[int], list[Edge]]:
    """Token borders of a stretch, and the candidate segments between them (indices of borders)."""
    borders = [m.start() for m in _TOKEN.finditer(t)] + [len(t)]
    edges = []
    for i in range(len(borders) - 1):
        c = t[borders[i]]
        if not (c in "+(" or c.isascii() and (c.isalnum() or c in "._%-")):
            continue
        for j in range(i + 1, min(i + LONGEST, len(borders) - 1) + 1):
            s = t[borders[i] : borders[j]]
            if s[-1] in "\n\t" or not s[-1].isascii():
                break
            for kind in KINDS:
                if _candidate(kind, s):
                    edges.append((i, j, kind, features(kind, t, borders[i], borders[j])))
    return borders, edges


def stretches(t: str, taken: list[Span]) -> Iterator[Span]:
    """Merged surroundings of the digits and @ signs that lie in no taken span, cut at taken spans."""
    taken = sorted(taken)
    k, lo, hi = 0, -1, -1
    for m in _ANCHOR.finditer(t):
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        if k < len(taken) and taken[k][0] < m.end():
            continue
        a = max(m.start() - REACH, taken[k - 1][1] if k else 0, 0)
        b = min(m.end() + REACH, taken[k][0] if k < len(taken) else len(t))
        if a <= hi and lo >= 0:
            hi = max(hi, b)
        else:
            if lo >= 0:
                yield lo, hi
            lo, hi = a, b
    if lo >= 0:
        yield lo, hi


# --- learning and decoding -------------------------------------------------------------------


def _add(a: float, b: float) -> float:
    if a == -math.inf:
        return b
    m = max(a, b)
    return m + math.log1p(math.exp(min(a, b) - m))


def _expected(n: int, edges: list[Edge], score: list[float]) -> list[float]:
    """Probability of each candidate segment; leaving a token alone scores zero."""
    into, out = [[] for _ in range(n + 1)], [[] for _ in range(n + 1)]
    for k, (i, j, _, _) in enumerate(edges):
        into[j].append(k)
        out[i].append(k)
    f, b = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(1, n + 1):
        f[j] = f[j - 1]
        for k in into[j]:
            f[j] = _add(f[j], f[edges[k][0]] + score[k])
    for i in range(n - 1, -1, -1):
        b[i] = b[i + 1]
        for k in out[i]:
            b[i] = _add(b[i], b[edges[k][1]] + score[k])
    return [math.exp(min(0.0, f[i] + s + b[j] - f[n])) for (i, j, _, _), s in zip(edges, score)]


def fit(samples: list[str]) -> dict[str, float]:
    """Weights from stretches whose base spans are the truth (per-feature step sizes, ``EPOCHS`` rounds)."""
    cases = []
    for t in samples:
        for text in dict.fromkeys([t, re.sub(r"\+[0-9]{1,3} (?=\()", "", t)]):
            gold = {(a, b, kind) for kind, spans in base_spans(text if text == t else t).items() for a, b in spans}
            if text != t:  # the same truth, with the country code cut off
                gold = {(m.start(), m.end(), "phone") for m in re.finditer(r"\([0-9]{2,5}\) [0-9]+(?:[ -][0-9]+)+", text)}
                gold |= {(a, b, kind) for kind, spans in base_spans(text).items() for a, b in spans}
            borders, edges = lattice(text)
            at = {x: i for i, x in enumerate(borders)}
            truth = {(at.get(a), at.get(b), kind) for a, b, kind in gold}
            if edges:
                cases.append((len(borders) - 1, edges, [(i, j, kind) in truth for i, j, kind, _ in edges]))
    w: dict[str, float] = {}
    seen: dict[str, float] = {}
    for _ in range(EPOCHS):
        for n, edges, truth in cases:
            score = [sum(w.get(x, 0.0) for x in fs) for *_, fs in edges]
            slope: dict[str, float] = {}
            for (_, _, _, fs), p, y in zip(edges, _expected(n, edges, score), truth):
                for x in fs:
                    slope[x] = slope.get(x, 0.0) + y - p
            for x, g in slope.items():
                g -= RIDGE * w.get(x, 0.0)
                seen[x] = seen.get(x, 1e-6) + g * g
                w[x] = w.get(x, 0.0) + RATE * g / math.sqrt(seen[x])
    return w


def decode(t: str, w: dict[str, float]) -> list[tuple[str, int, int]]:
    """The best segmentation of a stretch: its segments, each better than nothing by the margin."""
    borders, edges = lattice(t)
    if not edges:
        return []
    into: dict[int, list[Edge]] = {}
    for e in edges:
        into.setdefault(e[1], []).append(e)
    best, how = [0.0] * len(borders), [None] * len(borders)
    for j in range(1, len(borders)):
        best[j] = best[j - 1]
        for e in into.get(j, ()):
            # what training never saw speaks against a segment
            s = best[e[0]] + sum(w.get(x, -MARGIN) for x in e[3]) - MARGIN
            if s > best[j]:
                best[j], how[j] = s, e
    out, j = [], len(borders) - 1
    while j > 0:
        e = how[j]
        if e:
            out.append((e[2], borders[e[0]], borders[e[1]]))
        j = e[0] if e else j - 1
    return out[::-1]


def all_spans(t: str, w: dict[str, float]) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Base spans, and base spans plus those the model adds."""
    base = base_spans(t)
    full = {k: list(v) for k, v in base.items()}
    if w:
        for a, b in stretches(t, [s for spans in base.values() for s in spans]):
            for kind, i, j in decode(t[a:b], w):
                full[kind].append((a + i, a + j))
    return base, {k: sorted(v) for k, v in full.items()}


def joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k])


def fit_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", documents: int = DOCUMENTS) -> dict[str, float]:
    """Weights learned from a bounded sample of the documents."""
    n = docs.count()
    if not n:
        return {}
    share = min(1.0, documents / n)
    pick = F.pmod(F.xxhash64(F.lit(3), id_col), F.lit(1_000_000)) < F.lit(share * 1_000_000)

    @F.arrow_udf("array<string>")
    def near(column: pa.Array) -> pa.Array:
        return pa.array([[t[a:b] for a, b in stretches(t, [])] for t in texts(column)], pa.list_(pa.string()))

    found = docs.filter(pick).select(F.explode(near(F.col(text_col))).alias("s")).distinct()
    return fit([r["s"] for r in found.orderBy(F.xxhash64("s"), "s").limit(STRETCHES).collect()])


def find_pii(docs: DataFrame, weights: dict[str, float], text_col: str = "text", out: str = "pii") -> DataFrame:
    """The documents plus ``out``, a free name: base counts by kind, digest of the base spans, all spans as text."""
    claim(docs, out)
    fields = [*((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())]

    @F.arrow_udf("struct<n_email: bigint, n_ip: bigint, n_card: bigint, n_phone: bigint, base_sha256: string, spans: string>")
    def find(column: pa.Array) -> pa.Array:
        rows = []
        for t in texts(column):
            base, full = all_spans(t, weights)
            row = {f"n_{k}": len(base[k]) for k in KINDS}
            rows.append(row | {"base_sha256": hashlib.sha256(joined(base).encode()).hexdigest(), "spans": joined(full)})
        return pa.array(rows, pa.struct(fields))

    return docs.withColumn(out, find(F.col(text_col)))


def mask_pii(docs: DataFrame, weights: dict[str, float], text_col: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; overlapping spans as one."""

    @F.arrow_udf("string")
    def mask(column: pa.Array) -> pa.Array:
        rows = []
        for x in column:
            t = x.as_py()
            if t is None:
                rows.append(None)
                continue
            parts, last = [], 0
            for a, b, kind in sorted((a, b, k) for k, v in all_spans(t, weights)[1].items() for a, b in v):
                if a >= last:
                    parts += [t[last:a], f"<{kind}>"]
                last = max(last, b)
            rows.append("".join([*parts, t[last:]]))
        return pa.array(rows, pa.string())

    return docs.withColumn(text_col, mask(F.col(text_col)))
