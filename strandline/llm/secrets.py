"""Secret scans (2): one deterministic automaton for all rules, one byte pass per text.

A rule is a list of parts, each a list of alternative byte sequences of (bytes, least, most) items; its last item is
what a match is extended over. All rules' sequences become one non-deterministic automaton that may begin at any byte; subset construction and
partition refinement give a minimal transition array with an output set per state. The pass reports for each rule
where its matches end; a reversed automaton of the rule, run back from an end and no further than the last match of
that rule, gives the leftmost begin, so matches are leftmost and don't overlap. The strict form of a rule (a least
length) then drops failing matches, which have still used up their bytes.

Null texts are empty; empty texts, texts without secrets and repeated rows give a row each; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from strandline.llm.common import small_batches, table, text_chunks

LOWER, UPPER, DIGIT = b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
ALNUM = LOWER + UPPER + DIGIT
Item = tuple[bytes, int, int | None]


def word(text: str, any_case: bool = False) -> list[Item]:
    return [((c.lower() + c.upper()).encode() if any_case else c.encode(), 1, 1) for c in text]


Rule = list[list[list[Item]]]


def _assign(least: int) -> Rule:
    keys = [word(k, True) for k in ("password", "passwd", "secret", "token", "apikey", "api_key")]
    tail: list[Item] = [(b"\"'", 0, 1), (b" ", 0, None), (b":=", 1, 1), (b" ", 0, None), (b"\"'", 0, 1), (ALNUM + b"+/_.=-", least, None)]
    return [keys, [tail]]


def _run(head: list[Item], tail: bytes, least: int) -> tuple[Rule, Rule]:
    """head and then `least` or more of tail: counted in the strict form only, which keeps the joint automaton small."""
    return [[[*head, (tail, 1, None)]]], [[[*head, (tail, least, None)]]]


#: kind -> (rule, strict rule or None); the first three are the base kinds.
RULES: dict[str, tuple[Rule, Rule | None]] = {
    "assign": (_assign(1), _assign(6)),
    "access": _run(word("AKIA"), UPPER + DIGIT, 16),
    "hex": ([[[(DIGIT + b"abcdef", 24, None)]]], None),
    "github": _run([*word("gh"), (b"pousr", 1, 1), (b"_", 1, 1)], ALNUM, 20),
    "slack": _run([*word("xox"), (b"abprs", 1, 1), (b"-", 1, 1)], ALNUM + b"-", 10),
    "private_key": ([[word("-----BEGIN ") + [(UPPER + b" ", 0, None)] + word("PRIVATE KEY-----")]], None),
}
BASE = ("assign", "access", "hex")


class Automaton:
    """Minimal deterministic automaton: next state by [state, byte], and out[state], the rules that end there."""

    def __init__(self, rules: list[Rule], anywhere: bool):
        can: list[bytes] = []
        to: list[int] = []
        free: list[list[int]] = []  # states reached without a byte

        def state() -> int:
            can.append(b"")
            to.append(0)
            free.append([])
            return len(can) - 1

        begin, end = [], {}
        for r, rule in enumerate(rules):
            joint = state()
            begin.append(joint)
            for part in rule:
                after = state()
                for seq in part:
                    free[joint].append(s := state())
                    for c, least, most in seq:
                        for may_skip in [False] * least + [True] * (1 if most is None else most - least):
                            can[s], n = c, state()
                            to[s] = s if may_skip and most is None else n
                            free[s] += [n] * may_skip
                            s = n
                    free[s].append(after)
                joint = after
            end[joint] = r

        @functools.cache
        def closure(s: int) -> frozenset[int]:
            return frozenset({s}).union(*(closure(t) for t in free[s]))

        member = np.zeros((len(can), 256), bool)
        for s, c in enumerate(can):
            member[s, list(c)] = True
        columns, byte_class = np.unique(member.T, axis=0, return_inverse=True)
        steps = [set(np.flatnonzero(col).tolist()) for col in columns]
        start = frozenset().union(*(closure(b) for b in begin))
        number, order, table_ = {start: 0}, [start], []
        for states in order:
            row = []
            for over in steps:
                new = frozenset(start if anywhere else ()).union(*(closure(to[s]) for s in states & over))
                if new not in number:
                    number[new] = len(order)
                    order.append(new)
                row.append(number[new])
            table_.append(row)
        step = np.array(table_)
        outs = [tuple(sorted({end[s] for s in states if s in end})) for states in order]
        kinds = {o: k for k, o in enumerate(dict.fromkeys(outs))}
        block = np.array([kinds[o] for o in outs])
        factor = np.random.default_rng(0).integers(1, 1 << 63, step.shape[1] + 1, dtype=np.uint64) | np.uint64(1)
        while True:  # refine until states of a block agree on the blocks that follow
            with np.errstate(over="ignore"):  # rows as 64-bit digests
                row_key = (np.column_stack((block, block[step])).astype(np.uint64) * factor).sum(axis=1)
            _, new = np.unique(row_key, return_inverse=True)
            if new.max() == block.max():
                break
            block = new
        _, first = np.unique(block, return_index=True)
        self.next = block[step[first]][:, byte_class].astype(np.uint16)
        self.out = [outs[s] for s in first]
        self.start = int(block[0])

    @functools.cached_property
    def rows(self) -> list:
        """The transition array as lists that hold the next state's list; [256] is the state's output."""
        rows = [[None] * 257 for _ in self.out]
        for row, to, out in zip(rows, self.next.tolist(), self.out, strict=True):
            row[:256] = [rows[t] for t in to]
            row[256] = out
        return rows


class Scanner:
    def __init__(self, rules=RULES):
        self.kinds = list(rules)
        self.all = Automaton([loose for loose, _ in rules.values()], True)
        self.back = [Automaton([[[seq[::-1] for seq in part] for part in loose[::-1]]], False) for loose, _ in rules.values()]
        self.strict = [strict and Automaton([strict], False) for _, strict in rules.values()]

    def ends(self, data: bytes) -> dict[int, list[int]]:
        """Rule -> where its matches end, each as far on as it goes."""
        found: dict[int, list[int]] = {}
        row = self.all.rows[self.all.start]
        for i, b in enumerate(data):
            row = row[b]
            if row[256]:
                for r in row[256]:
                    e = found.setdefault(r, [])
                    if e and e[-1] == i:
                        e[-1] = i + 1
                    else:
                        e.append(i + 1)
        return found

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(begin, rule, end) in bytes, sorted."""
        spans = []
        for r, ends in self.ends(data).items():
            last, back, strict = 0, self.back[r], self.strict[r]
            rows = back.rows
            for end in ends:
                begin, row = None, rows[back.start]
                dead = self._dead(r)
                for i in range(end - 1, last - 1, -1):
                    row = row[data[i]]
                    if row[256]:
                        begin = i
                    elif row is dead:
                        break
                if begin is None:
                    continue
                last = end
                if strict:
                    row = strict.rows[strict.start]
                    for b in data[begin:end]:
                        row = row[b]
                    if not row[256]:
                        continue
                spans.append((begin, r, end))
        return sorted(spans)

    @functools.cache
    def _dead(self, r: int):
        rows = self.back[r].rows
        return next((row for row in rows if not row[256] and all(x is row for x in row[:256])), None)

    def of_text(self, text: str) -> list[tuple[int, int, int]]:
        """(begin, rule, end) in code points."""
        data = text.encode("utf-8", "surrogatepass")
        spans = self.spans(data)
        if len(data) == len(text):
            return spans
        at = {0: 0}
        done = 0
        for cut in sorted({c for b, _, e in spans for c in (b, e)}):
            at[cut] = at[done] + len(data[done:cut].decode("utf-8", "surrogatepass"))
            done = cut
        return [(at[b], r, at[e]) for b, r, e in spans]


@functools.cache
def scanner() -> Scanner:
    return Scanner()


def _joined(spans, kinds, keep) -> str:
    return ",".join(f"{kinds[r]}:{b}:{e}" for b, r, e in spans if keep(kinds[r]))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: how many secrets of each base kind, a digest of the base spans, and all spans as
    kind:begin:end in code points, by begin and then by kind as in RULES."""

    def run(batches):
        s = scanner()
        for ids, texts in text_chunks(batches):
            found = [s.of_text(t) for t in texts]
            counts = [[sum(s.kinds[r] == k for _, r, _ in f) for f in found] for k in BASE]
            digest = [hashlib.sha256(_joined(f, s.kinds, BASE.__contains__).encode()).hexdigest() for f in found]
            spans = [_joined(f, s.kinds, lambda k: True) for f in found]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in counts), pa.array(digest), pa.array(spans, pa.string())], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return small_batches(docs).select(docs[id_col].cast("long").alias("doc_id"), text_col).mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """text with each stretch that spans cover replaced by mark."""
    parts, done = [], 0
    for b, e in sorted(spans):
        if b >= done:
            parts += [text[done:b], mark]
        done = max(done, e)
    return "".join([*parts, text[done:]])


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with the secrets in `text` replaced by a mark and `n_chars` set anew; all other columns, null texts and
    texts without secrets stay as they are."""

    def run(batches):
        s = scanner()
        for batch in (b.slice(at, 1000) for b in batches for at in range(0, len(b), 1000)):
            k = batch.schema.get_field_index("text")
            texts = batch.column(k).to_pylist()
            new = [t and (redacted(t, [(b, e) for b, _, e in f], mark) if (f := s.of_text(t)) else t) for t in texts]
            cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            cols["text"] = pa.array(new, batch.schema.field(k).type)
            if "n_chars" in cols:
                cols["n_chars"] = pa.array([len(n) if n != t else old for n, t, old in zip(new, texts, cols["n_chars"].to_pylist(), strict=True)], cols["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return small_batches(docs).mapInArrow(run, docs.schema)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents"))
