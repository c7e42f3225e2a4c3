"""Secret scans: fixed patterns, and probabilistic automata learnt from what those patterns found.

The strings that the fixed patterns find are the labelled credentials, by kind. For each kind a prefix tree of their
character classes is folded into a probabilistic automaton: two states merge when, for every continuation, their
frequencies are no further apart than Hoeffding's bound allows. Every other run of a text over the alphabet that credentials
have is scored, whatever it consists of, by its mean log-likelihood per symbol under each automaton whose shortest credential
is no longer than the run. It is a secret (kind ``format``) when the score is typical of that automaton's own credentials: no
lower than nearly all of theirs, and no further above their median (a run of one and the same symbol is likelier than any
credential). Dots and equals signs join words to each other and to what ends a sentence: a run is read with and without those
at its ends, and the likeliest reading counts; where none is a secret, its parts between equals signs are read likewise, and
then theirs between dots. One more automaton is learnt in the same way from runs that no fixed pattern finds, and from their
parts, without those that are credentials themselves; a run that is likelier there is no secret.

The automata are fitted on at most ``TRAIN_PER_KIND`` distinct strings of each kind, of up to ``TRAIN_CHARS`` characters,
those of smallest hash over all documents; kinds without credentials have no automaton. Scanning covers every whole text. Null or empty text: no spans.
Repeated rows give repeated results. Positions are code points, ends exclusive. A span of the method never touches a base
span.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, dropped, mapped, per_slice, sliced, texts_of, written

KINDS, OTHER = ("assign", "access", "hex"), "other"
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Runs that are scored, and the length from which the fixed patterns take a value as a credential.
RUN, SHORTEST = re.compile(r"[A-Za-z0-9+/_.=-]+"), 8
#: Characters of a run that may join what it consists of, in the order in which it is cut at them.
JOINTS = "=."
TRAIN_PER_KIND, TRAIN_CHARS, ALPHA, QUANTILE = 400, 1_000, 0.05, 0.02
_CLASS = str.maketrans({**dict.fromkeys("0123456789", "d"), **dict.fromkeys("abcdef", "a"), **dict.fromkeys("ghijklmnopqrstuvwxyz", "l"), **dict.fromkeys("ABCDEF", "A"), **dict.fromkeys("GHIJKLMNOPQRSTUVWXYZ", "U")})
END = ""
FLOOR = -12.0  # log2 of the probability given to a symbol that a state has never seen


def find(text: str) -> list[tuple[str, int, int, str]]:
    """Base spans as (kind, start, end, credential)."""
    out = [("assign", m.start(), m.end(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= SHORTEST]
    out += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    return out + [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]


def candidates(text: str, taken: list[tuple[int, int]], shortest: int) -> Iterator[tuple[int, int]]:
    """Runs of at least ``shortest`` characters, or what the spans ``taken`` leave of them."""
    taken = sorted(taken)
    at, i = 0, 0
    for m in re.finditer(RUN.pattern[:-1] + f"{{{shortest},}}", text):
        start, stop = m.span()
        start = max(start, at)
        while i < len(taken) and taken[i][0] < stop:
            if taken[i][0] - start >= shortest:
                yield start, taken[i][0]
            at = max(at, taken[i][1])
            start, i = max(start, at), i + 1
        if stop - start >= shortest:
            yield start, stop


def readings(text: str, start: int, stop: int, shortest: int) -> list[tuple[int, int]]:
    """The run itself, and the run without joints at its ends, of at least ``shortest`` characters; the longest first."""
    run = text[start:stop]
    starts = {start, stop - len(run.lstrip(JOINTS))}
    stops = {stop, start + len(run.rstrip(".")), start + len(run.rstrip(JOINTS))}
    return sorted(((s, e) for s in starts for e in stops if e - s >= shortest), key=lambda x: (x[0] - x[1], x))


def parts(text: str, start: int, stop: int, joint: str, shortest: int) -> Iterator[tuple[int, int]]:
    """What lies between the joints of a run, of at least ``shortest`` characters."""
    for m in re.finditer(f"[^{joint}]{{{shortest},}}", text[start:stop]):
        yield start + m.start(), start + m.end()


class Automaton:
    """A probabilistic automaton over character classes."""

    def __init__(self, strings: list[str], alpha: float = ALPHA) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.count: list[Counter] = [Counter()]
        for s in strings:
            self._add(s.translate(_CLASS))
        self._bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_states()
        scores = sorted(map(self.score, strings))
        self.least = scores[int(len(scores) * QUANTILE)] if scores else math.inf
        self.most = 2 * scores[len(scores) // 2] - self.least if scores else -math.inf
        self.shortest = min(map(len, strings), default=math.inf)

    def _add(self, symbols: str) -> None:
        at = 0
        for c in symbols:
            self.count[at][c] += 1
            if c not in self.next[at]:
                self.next[at][c] = len(self.next)
                self.next.append({})
                self.count.append(Counter())
            at = self.next[at][c]
        self.count[at][END] += 1

    def _alike(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.count[a].total(), self.count[b].total()
            if not n or not m:
                continue
            limit = self._bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if limit >= 1:
                continue  # too few strings to tell them or what follows apart
            for c in self.count[a].keys() | self.count[b].keys():
                if abs(self.count[a][c] / n - self.count[b][c] / m) > limit:
                    return False
            todo += [(self.next[a][c], self.next[b][c]) for c in self.next[a].keys() & self.next[b].keys()]
        return True

    def _fold(self, into: int, state: int) -> list[int]:
        """Adds the subtree of ``state`` to what begins at ``into``; the states that have new children by it."""
        todo, opened = [(into, state)], []
        while todo:
            into, state = todo.pop()
            self.count[into] += self.count[state]
            for c, child in self.next[state].items():
                if c in self.next[into]:
                    todo.append((self.next[into][c], child))
                else:
                    self.next[into][c] = child
                    opened.append(into)
        return opened

    def _merge_states(self) -> None:
        """Settles states breadth first: each open child merges with the first settled state like it, or is settled."""
        settled, seen, place = [0], {0}, {0: 0}
        at = 0
        while at < len(settled):
            state = settled[at]
            for c in sorted(self.next[state]):
                child = self.next[state][c]
                if child in seen:
                    continue
                for old in settled:
                    if self._alike(old, child):
                        self.next[state][c] = old
                        # the fold may have opened new children of any state settled already
                        at = min([at, *(place[x] for x in self._fold(old, child) if x in place)])
                        break
                else:
                    place[child] = len(settled)
                    settled.append(child)
                    seen.add(child)
            if state == settled[at] and all(x in seen for x in self.next[state].values()):
                at += 1
        number = {s: i for i, s in enumerate(settled)}
        self.next = [{c: number[x] for c, x in self.next[s].items()} for s in settled]
        self.count = [self.count[s] for s in settled]

    def margin(self, string: str) -> tuple[float, float]:
        """How far the score is inside what is typical of the automaton's credentials (below 0: outside), and the score."""
        if len(string) < self.shortest:
            return -math.inf, -math.inf
        score = self.score(string)
        return min(score - self.least, self.most - score), score

    def score(self, string: str) -> float:
        """Mean log2-likelihood of a symbol, the end included."""
        at, total, n = 0, 0.0, 0
        for c in [*string.translate(_CLASS), END]:
            seen, n = self.count[at].total() if at >= 0 else 0, n + 1
            hits = self.count[at][c] if at >= 0 else 0
            total += math.log2(hits / seen) if hits else FLOOR
            at = self.next[at].get(c, -1) if at >= 0 else -1
        return total / n


class Smallest:
    """The ``TRAIN_PER_KIND`` distinct strings of smallest hash of each kind."""

    def __init__(self) -> None:
        from xxhash import xxh3_64_intdigest

        self._hash, self._heaps, self._has = xxh3_64_intdigest, {}, {}

    def add(self, kind: str, value: str) -> None:
        heap, has = self._heaps.setdefault(kind, []), self._has.setdefault(kind, set())
        if len(value) > TRAIN_CHARS or value in has:
            return
        item = (-self._hash(value), value)
        if len(heap) < TRAIN_PER_KIND:
            heapq.heappush(heap, item)
        elif item > heap[0]:
            has.discard(heapq.heapreplace(heap, item)[1])
        else:
            return
        has.add(value)

    def rows(self) -> list[tuple[str, str, int]]:
        return [(kind, value, -h - (1 << 63)) for kind, heap in self._heaps.items() for h, value in heap]


def examples(docs: DataFrame) -> DataFrame:
    """``(kind, value, h)``: what the fixed patterns find, and as ``other`` what runs they leave, with their parts.

    Distinct in each task, and of each kind the ``TRAIN_PER_KIND`` of smallest hash ``h`` there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = Smallest()
        for text in (x for part in sliced(batches) for x in texts_of(part)):
            found = find(text)
            for kind, _, _, value in found:
                least.add(kind, value)
            for s, e in candidates(text, [(s, e) for _, s, e, _ in found], SHORTEST):
                for x, y in {*readings(text, s, e, SHORTEST), *parts(text, s, e, JOINTS, SHORTEST)}:
                    least.add(OTHER, text[x:y])
        rows = least.rows()
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["kind", "value", "h"])

    return mapped(documents(docs, "text"), run, "kind string, value string, h bigint")


def fit(docs: DataFrame) -> dict[str, Automaton]:
    """One automaton for each kind, and for what is no credential, from a bounded number of distinct strings."""
    found = written(examples(docs), "credentials")
    values = found.distinct()
    models = {}
    for kind in (*KINDS, OTHER):
        rows = values.where(F.col("kind") == kind).orderBy("h", "value").limit(TRAIN_PER_KIND).collect()
        strings = [r.value for r in rows]
        if kind == OTHER:
            strings = ordinary(strings, list(models.values()))
        if strings:
            models[kind] = Automaton(strings)
    dropped(found)
    return models


def ordinary(strings: list[str], learnt: list[Automaton]) -> list[str]:
    """The strings without those that are credentials themselves, which no fixed pattern finds.

    Each half is judged by an automaton of the other, so that none speaks for itself: what is typical of credentials and
    likelier among them goes, until nothing more does.
    """
    while len(strings) > 1:
        halves = Automaton(strings[1::2]), Automaton(strings[::2])
        judged = [(x, max((m.margin(x) for m in learnt), default=(-1.0, 0.0)), halves[i % 2]) for i, x in enumerate(strings)]
        left = [x for x, (margin, score), other in judged if margin < 0 or other.score(x) >= score]
        if len(left) == len(strings):
            break
        strings = left
    return strings


def judge(text: str, models: dict[str, Automaton]) -> list[tuple[str, int, int, float]]:
    """All spans in order, as (kind, start, end, score); base spans have the score 0."""
    order = {k: i for i, k in enumerate((*KINDS, "format"))}
    spans = [(k, s, e, 0.0) for k, s, e, _ in find(text)]
    learnt = [m for k, m in models.items() if k != OTHER]
    if learnt:
        shortest = min(m.shortest for m in learnt)
        todo = [(s, e, 0) for s, e in candidates(text, [(s, e) for _, s, e, _ in spans], shortest)]
        while todo:
            start, stop, cuts = todo.pop()
            best = None
            for s, e in readings(text, start, stop, shortest):
                margin, score = max(m.margin(text[s:e]) for m in learnt)
                if margin >= 0 and (best is None or score > best[2]) and (OTHER not in models or models[OTHER].score(text[s:e]) < score):
                    best = s, e, score
            if best:
                spans.append(("format", *best))
            else:
                # without the joint the only part is the run itself, which needs no second look
                cuts = next((i for i in range(cuts, len(JOINTS)) if JOINTS[i] in text[start:stop]), len(JOINTS))
                if cuts < len(JOINTS):
                    todo += [(s, e, cuts + 1) for s, e in parts(text, start, stop, JOINTS[cuts], shortest)]
    return sorted(spans, key=lambda x: (x[1], order[x[0]]))


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans array<struct<kind,start,end,score>>)`` for each row."""
    models = fit(docs)
    key = docs.schema["doc_id"].dataType.simpleString()
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            spans = [[dict(zip(("kind", "start", "end", "score"), x, strict=True)) for x in judge(t, models)] for t in texts_of(batch)]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, pa.list_(item))], ["doc_id", "spans"])

        return work

    return per_slice(documents(docs, "doc_id", "text"), make, f"doc_id {key}, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>")


def digests(spans: DataFrame) -> DataFrame:
    """The query's columns."""
    said = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    base = F.filter("spans", lambda x: x["kind"] != "format")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return spans.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(F.array_join(F.transform(base, said), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", said), ",").alias("spans"),
        count("format"),
    )


def redact(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """The rows of ``docs`` with every span of ``text`` replaced by ``mask``; spans that overlap become one mask.

    ``n_chars``, where there is such a column, becomes the new length. Null text stays null.
    """
    models = fit(docs)
    fields = docs.schema

    def make():
        def clean(text: str | None) -> str | None:
            if not text:
                return text
            out, at = [], 0
            for _, s, e, _ in judge(text, models):
                if s >= at:
                    out += [text[at:s], mask]
                at = max(at, e)
            return "".join([*out, text[at:]])

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            i = batch.schema.get_field_index("text")
            return batch.set_column(i, "text", pa.array([clean(x) for x in batch.column("text").to_pylist()], pa.string()))

        return work

    out = per_slice(docs, make, fields)
    return out.withColumn("n_chars", F.length("text").cast(fields["n_chars"].dataType)) if "n_chars" in fields.names else out
