"""Personal data (9): candidate spans, gradient-boosted trees over their format and context, calibrated thresholds.

Two sorts of generators propose overlapping spans: the strict formats (email, ip, card, phone), whose valid matches are
always redacted, and loose ones that take in addresses and dots in brackets or spelt out, and runs and parts of runs of
digits with any separators. Boosted trees, trained here, score the loose candidates by format and context.

They learn what no strict format says: valid strict matches of a sample of the texts, written otherwise in their own
context (`disturbed`: without plus, with other separators, brackets, dots or at signs spelt out) are right; the texts'
other candidates, candidates that cut such a span wrongly, and look-alikes (versions, dates, ids, failing check digits)
in contexts of the same texts are wrong. A part of the examples has its format hidden, so that the context counts too.
A kind's threshold is the lowest score from which examples of texts that no tree has seen are right in PRECISION of
cases. Accepted candidates that overlap a strict match or a better candidate are dropped.

Only training is bounded: SAMPLE_TEXTS texts of at most SAMPLE_CHARS characters with candidates, by the hash of their id.
Null texts are empty; texts without candidates and repeated rows give a row each; other columns are ignored. Every
generator takes time in proportion to the text, whatever its length.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import small_batches, table, text_chunks

KINDS = ("email", "ip", "card", "phone")
SAMPLE_TEXTS, SAMPLE_CHARS, PRECISION = 2000, 20_000, 0.98

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT = re.compile(r"(?<![^\s@<>\"'(),;])[^\s@<>\"'(),;]{1,64}@[^\s@<>\"'(),;]{1,255}")
_NUMBER = re.compile(r"\+?\(?[0-9][0-9\x20()./_-]*[0-9]")
_DOT = r"\x20?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)|\bdot\b|\.)\x20?"
_SPELT = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}\x20?(?:\(at\)|\[at\]|\bat\b|@)\x20?[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,4}}")
_SPELT_IP = re.compile(rf"(?<![0-9.])[0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}}(?![0-9])")
_SPELLING = re.compile(r"\bdot\b|\[dot|\(dot|\[\.|\(\.|\(at\)|\[at\]|\x20[.@]\x20")
_DIGITS = re.compile("[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(begin, kind, end) of valid strict matches, by begin and kind."""
    found = []
    last = 0
    at = text.find("@")
    while at >= 0:
        b = at
        while b > last and text[b - 1] in _LOCAL:
            b -= 1
        m = _DOMAIN.match(text, at) if b < at else None
        if m:
            found.append((b, 0, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (part.lstrip("0") for part in m[0].split("."))):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(map(len, _DIGITS.findall(m[0]))) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(begin, kind, end) of everything that the loose generators propose."""
    found = set()
    if "@" in text:
        found |= {(m.start(), 0, m.end()) for m in _AT.finditer(text)}
    if _SPELLING.search(text):
        found |= {(m.start(), 0, m.end()) for m in _SPELT.finditer(text)} | {(m.start(), 1, m.end()) for m in _SPELT_IP.finditer(text)}
    for m in _NUMBER.finditer(text):
        if m.end() - m.start() < 7:
            continue
        groups = [(g.start() + m.start(), g.end() + m.start()) for g in _DIGITS.finditer(m[0])]
        sizes = [e - b for b, e in groups]
        digits = sum(sizes)
        if digits < 7:
            continue
        kind = lambda n: 3 if n < 13 else 2
        found.add((m.start(), 1 if m[0].count(".") == 3 and " " not in m[0] else 3 if m[0][0] == "+" else kind(digits), m.end()))
        if len(groups) > 1:  # parts of the run
            found |= {(b, kind(e - b), e) for b, e in groups if e - b >= 7}
            found |= {(groups[k][0], 2, groups[k + 3][1]) for k in range(len(groups) - 3) if sizes[k : k + 4] == [4, 4, 4, 4]}
            for k in range(len(groups) - 2):
                if sizes[k : k + 3] == [3, 3, 4]:
                    b = groups[k][0]
                    found.add((b - (b > 0 and text[b - 1] == "("), 3, groups[k + 2][1]))
    return sorted(found)


# ------------------------------------------------------------------ examples
def disturbed(kind: int, s: str, rng: random.Random) -> str:
    """A valid strict match written as the strict formats don't have it."""
    digits = "".join(_DIGITS.findall(s))
    if kind == 0:
        local, _, domain = s.partition("@")
        at, dot = rng.choice([(" (at) ", "."), (" [at] ", " [dot] "), (" at ", " dot "), ("@", "[.]"), (" @ ", "."), ("(at)", "(dot)")])
        return local + at + domain.replace(".", dot)
    if kind == 1:
        return s.replace(".", rng.choice(["[.]", "(.)", " . ", " dot ", "[dot]"]))
    if kind == 2:
        return rng.choice([".", "/", "  ", "_", " - ", "--"]).join(digits[k : k + 4] for k in range(0, len(digits), 4))
    own = digits[-10:]
    a, b, c = own[:3], own[3:6], own[6:]
    return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"00{digits[:-10] or 1} {a} {b} {c}", f"+{digits[:-10] or 1}/{a}/{b}/{c}", f"({a}) {b} {c}"])


def look_alike(rng: random.Random) -> str:
    """Something that is shaped like personal data and isn't."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    card = d(16)
    if luhn(card):
        card = card[:-1] + str((int(card[-1]) + 1) % 10)
    year = str(rng.randrange(1900, 2100))
    return rng.choice([
        f"{year}-{d(2)}-{d(2)} {d(2)}:{d(2)}", f"{d(2)}.{d(2)}.{year}", f"{d(2)}/{d(2)}/{year} {d(4)}", f"{year}-{rng.randrange(1900, 2100)}", f"{year}{d(4)}-{d(6)}", card, ".".join(card[k : k + 4] for k in (0, 4, 8, 12)), "/".join(card[k : k + 4] for k in (0, 4, 8, 12)),
        f"v{d(1)}.{d(2)}.{d(4)}", f"version {d(1)}.{d(1)}.{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(3)},00", f"{d(1)}.{d(9)}", f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", f"#{d(8)}", f"ID {d(6)}-{d(4)}", f"{d(1)}.{rng.randrange(300, 999)}.{d(1)}.{d(2)}",
        f"{d(1)} . {rng.randrange(300, 999)} . {d(1)} . {rng.randrange(256, 999)}", f"at {d(1)} dot matrix", f"looked at it. {d(1)}", f"user@{d(2)}", f"{d(2)}@{d(3)}", f"x{d(3)} at home . then", f"{d(7)}", f"{d(5)} {d(5)}", f"{d(2)} {d(3)} {d(4)} {d(2)} {d(3)}",
    ])


#: In how many ways each strict match is written, and look-alikes put beside it.
WAYS = 4


def examples(text: str, rng: random.Random, most: int = 20) -> list[tuple[int, list[float], bool]]:
    """(kind, features, right) from one text, `most` of each sort at most."""
    strict = base_spans(text)
    out, spaces = [], [m.start() for m in re.finditer(" ", text)]
    inside = lambda b, e: any(b < z and a < e for a, _, z in strict)
    out += [(k, features(text, b, k, e), False) for b, k, e in candidates(text) if not inside(b, e)][:most]

    def put(before: str, new: str, after: str, kind: int | None):
        whole, low = before + new + after, len(before)
        own = set(base_spans(whole))
        for b, k, e in candidates(whole):
            if (b, k, e) not in own and b < low + len(new) and e > low and not any(b < z and a < e for a, _, z in own):
                out.append((k, features(whole, b, k, e), k == kind and b == low and e == low + len(new)))

    for b, k, e in strict[:most]:
        for _ in range(WAYS):
            put(text[max(0, b - 40) : b], disturbed(k, text[b:e], rng), text[e : e + 10], k)
        for _ in range(WAYS if spaces else 0):
            at = rng.choice(spaces) + 1
            put(text[max(0, at - 40) : at], look_alike(rng), " " + text[at : at + 10], None)
    return out


_HINTS = (("mail", "contact", "write"), ("ip", "host", "server", "addr"), ("card", "visa", "pay", "credit"), ("call", "tel", "phone", "fax", "mobil"))


def features(text: str, b: int, kind: int, e: int) -> list[float]:
    s = text[b:e]
    groups = _DIGITS.findall(s)
    digits = "".join(groups)
    before, after = text[max(0, b - 24) : b].lower(), text[e : e + 1]
    return [
        kind, 1.0, len(s), len(digits), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        s.count("."), s.count("-"), s.count(" "), s.count("("), s.count("@"), s[0] == "+", sum(c.isalpha() for c in s),
        float(len(digits) >= 12 and luhn(digits[:40])), max((min(int(g[:6]), 999) for g in groups), default=0), "." in s.rpartition("@")[2], s.isascii(),
        s[-1:].isalnum(), "at" in s.lower(), "dot" in s.lower(), "[" in s, s.count("/") + s.count("_"), groups[:1] == ["00"] or digits[:2] == "00", 1900 <= int((groups or ["0"])[0][:6]) < 2100, len(set(map(len, groups))),
        before[-1:].isalnum(), after.isalnum(), before[-1:].isspace(), *(any(h in before for h in hints) for hints in _HINTS),
    ]


# ------------------------------------------------------------------ boosted trees
DEPTH, ROUNDS, RATE, BINS = 4, 80, 0.2, 32


def boost(x: np.ndarray, y: np.ndarray) -> dict:
    """Trees of second-order gradient boosting for the logistic loss, over quantile bins."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    score = np.full(len(y), prior := float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))
    trees = []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        grad, hess = y - p, p * (1 - p) + 1e-6
        at, tree = np.zeros(len(y), np.int64), []
        for depth in range(DEPTH):
            level = []
            for leaf in range(1 << depth):
                rows = np.flatnonzero(at == leaf)
                best = (1e-9, 0, BINS)  # all rows to the left
                g, h = grad[rows].sum(), hess[rows].sum()
                for j in range(x.shape[1]) if len(rows) > 1 else ():
                    gl = np.cumsum(np.bincount(binned[rows, j], grad[rows], BINS + 1))[:-1]
                    hl = np.cumsum(np.bincount(binned[rows, j], hess[rows], BINS + 1))[:-1]
                    gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                    if gain[k := int(gain.argmax())] > best[0]:
                        best = (float(gain[k]), j, k)
                level.append(best[1:])
            tree.append(level)
            j, k = np.array(level)[at].T
            at = 2 * at + (binned[np.arange(len(y)), j] > k)
        value = RATE * np.bincount(at, grad, 1 << DEPTH) / (np.bincount(at, hess, 1 << DEPTH) + 1)
        score += value[at]
        trees.append((tree, value))
    return {"cuts": cuts, "prior": prior, "trees": trees}


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(model["cuts"])], 1)
    score, rows = np.full(len(x), model["prior"]), np.arange(len(x))
    for tree, value in model["trees"]:
        at = np.zeros(len(x), np.int64)
        for level in tree:
            j, k = np.array(level)[at].T
            at = 2 * at + (binned[rows, j] > k)
        score += value[at]
    return 1 / (1 + np.exp(-score))


#: Share of the examples whose format is hidden, and the features that stay then: the kind and the context.
HIDDEN, CONTEXT = 0.15, 7


def fit(texts: list[str], seed: int = 5) -> dict | None:
    """Trees of the even texts' examples and, from the odd ones', a threshold per kind; None without any to learn from."""
    rng = random.Random(seed)
    data = [(k % 2, *x) for k, t in enumerate(texts) for x in examples(t, rng)]
    x, y = np.array([d[2] for d in data], float), np.array([d[3] for d in data], float)
    odd, kind = np.array([d[0] for d in data], bool), np.array([d[1] for d in data])
    if len(data) < 20 or len(set(y[~odd])) < 2 or not odd.any():
        return None
    seen = x[~odd].copy()
    hide = np.random.default_rng(seed).random(len(seen)) < HIDDEN
    seen[hide, 1:-CONTEXT] = -1
    model = boost(seen, y[~odd])
    p = predict(model, x[odd])
    model["threshold"], model["recall"] = [], []
    for k in range(len(KINDS)):
        own = np.flatnonzero(kind[odd] == k)
        own = own[np.argsort(-p[own], kind="stable")]
        right = np.cumsum(y[odd][own]) / np.arange(1, len(own) + 1)
        good = np.flatnonzero((right >= PRECISION) & (p[own] > 0.5) & np.append(np.diff(p[own]) < 0, True)[: len(own)])
        # a kind with too few cases to calibrate adds nothing
        use = len(good) and len(own) >= 20
        model["threshold"].append(float(p[own[good[-1]]]) if use else 2.0)
        model["recall"].append(float(y[odd][own[: good[-1] + 1]].sum() / max(1, y[odd][own].sum())) if use else 0.0)
    return model


def pii_model(docs: DataFrame) -> dict | None:
    some = docs.where(F.length("text").between(1, SAMPLE_CHARS)).where(F.col("text").rlike(r"@|[0-9][0-9 ().-]{5,}[0-9]"))
    some = some.select("text", F.xxhash64("text").alias("h"), F.xxhash64("doc_id").alias("o"))
    # different texts, each by the least of its rows, however many there are
    chosen = some.groupBy("h").agg(F.min("o").alias("least")).orderBy("least", "h").limit(SAMPLE_TEXTS)
    sample = some.join(F.broadcast(chosen), "h").groupBy("least", "h").agg(F.min("text").alias("text"))
    return fit([r["text"] for r in sorted(sample.toLocalIterator(), key=lambda r: (r["least"], r["h"]))])


def spans_of(texts: list[str], model: dict | None) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """(strict spans, all spans to redact) of each text."""
    strict = [base_spans(t) for t in texts]
    if model is None:
        return [(s, s) for s in strict]
    taken = []  # stretches of each text, which don't overlap
    for own in strict:
        stretches: list[tuple[int, int]] = []
        for b, _, e in own:
            if stretches and b < stretches[-1][1]:
                b, e = stretches[-1][0], max(e, stretches.pop()[1])
            stretches.append((b, e))
        taken.append(stretches)

    def free(i: int, b: int, e: int) -> int | None:
        """Where b to e belongs among the stretches of text i, None if it overlaps one."""
        at = bisect.bisect_left(taken[i], (b, e))
        clash = (at and taken[i][at - 1][1] > b) or (at < len(taken[i]) and taken[i][at][0] < e)
        return None if clash else at

    more = [(i, s) for i, t in enumerate(texts) for s in candidates(t) if free(i, s[0], s[2]) is not None]
    added: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if more:
        p = predict(model, np.array([features(texts[i], *s) for i, s in more], float))
        for q, i, s in sorted(((q, i, s) for q, (i, s) in zip(p.tolist(), more, strict=True) if q >= model["threshold"][s[1]]), key=lambda v: (-v[0], v[1:])):
            at = free(i, s[0], s[2])
            if at is not None:
                taken[i].insert(at, (s[0], s[2]))
                added[i].append(s)
    return [(s, sorted(s + a)) for s, a in zip(strict, added, strict=True)]


def pii_spans(docs: DataFrame, model: dict | None) -> DataFrame:
    """A row per document: the strict spans of each kind counted, their digest, and all spans as kind:begin:end in code
    points, by begin and then by kind."""

    def joined(spans):
        return ",".join(f"{KINDS[k]}:{b}:{e}" for b, k, e in spans)

    def run(batches):
        for ids, texts in text_chunks(batches):
            found = spans_of(texts, model)
            counts = [[sum(s[1] == k for s in strict) for strict, _ in found] for k in range(len(KINDS))]
            digest = [hashlib.sha256(joined(strict).encode()).hexdigest() for strict, _ in found]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in counts), pa.array(digest), pa.array([joined(every) for _, every in found], pa.string())], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii_spans(docs, pii_model(docs))
