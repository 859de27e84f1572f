"""Chat formatting: roles of raw transcript lines by a hidden Markov model, and
canonical rendering of the turns.

A transcript is a sequence of fragments ``(conversation, position, text)``; the
lines of all fragments in order are the observations. The hidden state of a
line is its speaker's role and whether it opens a turn. A line is observed
through its speaker marker (the word in ``User:``, ``### Response:``,
``[BOT]``, ``<|user|>``, ...) and a few features (length, ending, first
character, list or code shape). ``fit`` counts starts, transitions and
emissions over labelled fragments; ``parse`` finds the most likely states
(Viterbi) and renders them; content loses the marker that opened its turn.

Any word may stand before a colon or bracket (YAML keys, logs, ``Note:``). One
that opens turns at least twice more than it is seen in content (in lines that
go on, or after another marker) is a speaker marker and has its own row of
counts; the counts of all other words are summed in Spark into one row, used for
every word that is not a speaker marker. There is no cap: the model holds the
speaker markers of the labelled rows, and those of equal counts share one list
of numbers. A line that opens a turn loses only a speaker marker that opened
turns of its role before; other words stay in the content.

Scale. Conversations are not gathered: fragments are range-partitioned by
(conversation, position), so one that holds a third of all rows is spread over
many partitions. Viterbi is carried across the cuts exactly: a first pass gives
for each partition the best scores from every role before it to every role at
its end (a max-plus matrix of a few numbers), the driver combines these (one row
a partition) and fixes the role at each cut, and a second pass decodes every
partition between its fixed ends. The ordered fragments are checkpointed, so a
lost task repeats on the same partition.

Output: one row for each run of lines of one turn inside a fragment; joined in
order of (conversation, position, part) the column ``rendered`` is the canonical
text: every turn is ``<|im_start|>role\\n...<|im_end|>\\n``.

Edge cases: a null text has no lines (and no row), an empty one has one blank
line; rows of equal (conversation, position) are taken in order of a hash of their
text, repeated rows one after the other; null conversations form one, null positions
come first; labels outside ``ROLES`` are not learned from; with nothing to learn
from, all roles are equally likely; no rows give no rows; columns besides the
named ones are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Set
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import map_rows

ROLES = ("system", "user", "assistant")
NEVER = -math.inf
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"

_MARKER = re.compile(r"\s*(?:#{1,6}\s*|<\|?|\[|\*\*)?([A-Za-z]{1,20})\s*(?:\|?>|\]|:\*\*|\*\*:|:(?!//))\s*")


# -- observations -----------------------------------------------------------

def observe(line: str) -> tuple[str, ...]:
    """Marker and features of a line."""
    found = _MARKER.match(line)
    body = (line[found.end():] if found else line).strip()
    size = 0 if not body else 1 + min(5, len(body).bit_length() // 2)
    last = "" if not body else body[-1] if body[-1] in ".?!:,;" else "x"
    first = "" if not body else "A" if body[0].isupper() else "a" if body[0].isalpha() else \
        "0" if body[0].isdigit() else body[0] if body[0] in "-*#`>" else "x"
    return (found[1].lower() if found else "", str(size), last, first)


def marker_end(line: str) -> int:
    found = _MARKER.match(line)
    return found.end() if found else 0


def marker_within(line: str) -> str:
    """The word of a marker that follows the line's marker, so is content."""
    return observe(line[marker_end(line):])[0] if marker_end(line) else ""


def lines_of(text: str | None) -> list[str]:
    return [] if text is None else text.split("\n")


# -- model --------------------------------------------------------------------

class Model:
    """Log probabilities. States are numbered 2 * role (opens a turn) and
    2 * role + 1 (goes on)."""

    def __init__(self, counts: dict[tuple, int]):
        n = len(ROLES)
        share = lambda a, total, kinds: math.log((a + 0.5) / (total + 0.5 * kinds))
        starts = [counts.get(("start", r), 0) for r in range(n)]
        self.start = [share(s, sum(starts), n) for s in starts]
        turns = [sum(counts.get(("turn", r, q), 0) for q in range(n)) for r in range(n)]
        on = [counts.get(("on", r), 0) for r in range(n)]
        opened = [counts.get(("open", r), 0) for r in range(n)]
        # after a line of role r: the turn goes on, or another one opens
        self.on = [share(on[r], on[r] + opened[r], 2) for r in range(n)]
        self.turn = [[share(opened[r], on[r] + opened[r], 2) + share(counts.get(("turn", r, q), 0), turns[r], n)
                      for q in range(n)] for r in range(n)]
        self.seen: list[dict[str, list[float]]] = []
        self.other: list[list[float]] = []
        # markers: ("" for none, None for all that are not a speaker's)
        marks: dict[str | None, list[int]] = {"": [0] * 2 * n, None: [0] * 2 * n}
        for k, c in counts.items():
            if k[0] == "see" and k[1] == 0:
                marks.setdefault(k[2], [0] * 2 * n)[k[3]] += c
        # the roles whose turns a marker opened
        self.speakers = {m: sum(1 << r for r in range(n) if c[2 * r]) for m, c in marks.items() if m}
        total = [sum(c[s] for c in marks.values()) for s in range(2 * n)]
        part = [(t + 0.5) / (sum(total) + n) for t in total]
        made: dict[tuple[int, ...], list[float]] = {}

        def odds(c: list[int]) -> list[float]:
            # how much likelier the word is in a state than at all; 1 without
            # evidence, so that a rare word never favours a state of few lines
            if tuple(c) not in made:
                made[tuple(c)] = [math.log((c[s] / part[s] + 1) / (sum(c) + 1)) for s in range(2 * n)]
            return made[tuple(c)]

        self.other.append(odds(marks.pop(None)))
        self.seen.append({m: odds(c) for m, c in marks.items()})
        for f in range(1, 4):
            by: dict[str, list[int]] = {}
            for k, c in counts.items():
                if k[0] == "see" and k[1] == f:
                    by.setdefault(k[2], [0] * 2 * n)[k[3]] += c
            total = [sum(v[s] for v in by.values()) for s in range(2 * n)]
            kinds = len(by) + 1
            self.seen.append({v: [share(c[s], total[s], kinds) for s in range(2 * n)] for v, c in by.items()})
            self.other.append([share(0, total[s], kinds) for s in range(2 * n)])

    @property
    def markers(self) -> Set[str]:
        return self.speakers.keys()

    def marked(self, line: str, role: int) -> int:
        """Length of the speaker marker of a line that opens a turn of the role."""
        return marker_end(line) if self.speakers.get(observe(line)[0], 0) >> role & 1 else 0

    def emission(self, line: str) -> list[float]:
        tables = [self.seen[f].get(v, self.other[f]) for f, v in enumerate(observe(line))]
        return [sum(x) for x in zip(*tables)]

    def step(self, best: list[float], none: float, emission: list[float]) -> tuple[list[float], list[int]]:
        """One line: best score by state, and for each state the role before it
        (-1: none). ``best`` is by role, ``none`` the score of no line yet."""
        n, out, back = len(ROLES), [], []
        for q in range(n):
            score, role = none + self.start[q], -1
            for r in range(n):
                s = best[r] + self.turn[r][q]
                if s > score:
                    score, role = s, r
            out.append(score + emission[2 * q])
            back.append(role)
            out.append(best[q] + self.on[q] + emission[2 * q + 1])
            back.append(q)
        return out, back

    @staticmethod
    def by_role(scores: list[float]) -> list[float]:
        return [max(scores[k], scores[k + 1]) for k in range(0, len(scores), 2)]

    def transfer(self, emissions: list[list[float]]) -> list[list[float]]:
        """Best score from each role before the lines (last: none yet) to each
        role after them (last: still none)."""
        n, out = len(ROLES), []
        for first in range(n + 1):
            best, none = [0.0 if r == first else NEVER for r in range(n)], 0.0 if first == n else NEVER
            for e in emissions:
                best, none = self.by_role(self.step(best, none, e)[0]), NEVER
            out.append([*best, none])
        return out

    def decode(self, emissions: list[list[float]], before: int, after: int | None) -> list[int]:
        """The best states between a fixed role before (or none: the number of
        roles) and, if given, a fixed role at the last line."""
        n = len(ROLES)
        best, none = [0.0 if r == before else NEVER for r in range(n)], 0.0 if before == n else NEVER
        trail = []
        for e in emissions:
            scores, back = self.step(best, none, e)
            trail.append((scores, back))
            best, none = self.by_role(scores), NEVER
        states: list[int] = []
        role = after if after is not None else max(range(n), key=lambda r: (best[r], -r))
        for scores, back in reversed(trail):
            state = 2 * role if scores[2 * role] >= scores[2 * role + 1] else 2 * role + 1
            states.append(state)
            role = back[state]
        return states[::-1]


# -- partitions ---------------------------------------------------------------

def ordered(rows: DataFrame, conversation: str = "conv_id", position: str = "turn", text: str = "text",
            role: Column | None = None) -> DataFrame:
    """Fragments ``(c, p, text, role)`` in order over range partitions, checkpointed."""
    role = F.lit(None).cast("string") if role is None else role
    found = rows.select(F.col(conversation).alias("c"), F.col(position).alias("p"), F.col(text).alias("text"),
                        role.alias("role"))
    # rows of one place are told apart by a hash and a row number, so that many
    # copies of one row spread, and the sampled range keys stay small
    keyed = found.withColumns({"_h": F.xxhash64("text", "role"), "_row": F.monotonically_increasing_id()})
    keys = ["c", "p", "_h", "_row"]
    return materialize(keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_h", "_row"))


def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def fit(rows: DataFrame) -> Model:
    """Counts over the labelled fragments of ``ordered`` rows. The driver gets
    the counts of feature values and speaker markers, and one row for each partition."""
    number = {r: k for k, r in enumerate(ROLES)}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        edge, last = None, None
        for c, _, text, role in fragments(batches):
            if role not in number:
                last = (c, None)
                edge = edge or (c, None)
                continue
            r = number[role]
            if last is None:
                edge = (c, r)
            elif last[0] != c:
                counts["start", r] += 1
            elif last[1] is not None:
                counts["turn", last[1], r] += 1
            if last and last[0] == c and last[1] is not None:
                counts["open", last[1]] += 1
            last = (c, r)
            for k, line in enumerate(lines_of(text)):
                if k:
                    counts["on", r] += 1
                elif within := marker_within(line):
                    counts["mark", 0, within, 2 * len(ROLES)] += 1  # no state: seen in content
                for f, v in enumerate(observe(line)):
                    counts["see" if f or not v else "mark", f, v, 2 * r + (k > 0)] += 1
        if edge:
            pid = TaskContext.get().partitionId()
            rows = [("edge", pid, str(edge[0]), edge[1], str(last[0]), last[1])]
            rows += [("mark", n, k[2], k[3], None, None) if k[0] == "mark" else
                     ("count", n, repr(k), None, None, None) for k, n in counts.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in rows], t) for i, t in enumerate(
                    (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))],
                names=["kind", "n", "k", "first", "last_k", "last"])

    found = materialize(map_rows(rows, task, "kind string, n long, k string, first long, last_k string, last long"))
    import ast
    counts: Counter = Counter()
    for row in found.where("kind = 'count'").groupBy("k").agg(F.sum("n").alias("n")).collect():
        counts[ast.literal_eval(row["k"])] += row["n"]
    states = range(2 * len(ROLES))
    marks = found.where("kind = 'mark'").groupBy("k").agg(
        F.sum("n").alias("seen"),
        *[F.sum(F.when(F.col("first") == s, F.col("n")).otherwise(0)).alias(f"s{s}") for s in states])
    opening = sum((F.col(f"s{s}") for s in states if s % 2 == 0), F.lit(0))
    # the words that are no speaker's are summed under null
    marks = marks.withColumn("k", F.when(opening >= F.col("seen") - opening + 2, F.col("k")))
    for row in marks.groupBy("k").agg(*[F.sum(f"s{s}").alias(f"s{s}") for s in states]).collect():
        for s in states:
            counts["see", 0, row["k"], s] += row[f"s{s}"]
    before = None  # the conversation and role at the end of the partition before
    for row in found.where("kind = 'edge'").orderBy("n").collect():
        if row["first"] is not None:
            if before is None or before[0] != row["k"]:
                counts["start", row["first"]] += 1
            elif before[1] is not None:
                counts["turn", before[1], row["first"]] += 1
                counts["open", before[1]] += 1
        before = (row["last_k"], row["last"])
    return Model(counts)


def cuts(rows: DataFrame, model: Model) -> dict[int, tuple[int, int | None, bool]]:
    """For each partition: the role before its first conversation (or none), the
    role at its end if its last conversation goes on, and whether it does."""
    n = len(ROLES)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for k, (c, part) in enumerate(groupby(fragments(batches), key=lambda x: x[0])):
            emissions = (model.emission(line) for x in part for line in lines_of(x[2]))
            # the matrix needs one pass over the lines for each role before them
            held = list(emissions)
            if k == 0 or len(out) < 2:
                out.append((c, len(held), model.transfer(held)))
            else:
                out[1] = (c, len(held), None)
                tail = held
        if len(out) == 2 and out[1][2] is None:
            out[1] = (*out[1][:2], model.transfer(tail))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()] * len(out), pa.int64()),
                 pa.array(range(len(out)), pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                 pa.array([x[0] is None for x in out]), pa.array([str(x[0]) for x in out]),
                 pa.array([[s for row in x[2] for s in row] for x in out], pa.list_(pa.float64()))],
                names=["pid", "k", "lines", "none", "c", "matrix"])

    kind = "pid long, k long, lines long, none boolean, c string, matrix array<double>"
    parts = [r for r in sorted(map_rows(rows, task, kind).collect(), key=lambda r: (r["pid"], r["k"]))]
    chains: list[list] = []  # parts of one conversation, in order
    for r in parts:
        if chains and r["k"] == 0 and (chains[-1][-1]["c"], chains[-1][-1]["none"]) == (r["c"], r["none"]):
            chains[-1].append(r)
        else:
            chains.append([r])
    ends = {r["pid"]: (n, None, False) for r in parts}
    for chain in chains:
        score, backs = [NEVER] * n + [0.0], []
        for r in chain:
            m = [r["matrix"][i * (n + 1):(i + 1) * (n + 1)] for i in range(n + 1)]
            back = [max(range(n + 1), key=lambda i, j=j: (score[i] + m[i][j], -i)) for j in range(n + 1)]
            score = [score[back[j]] + m[back[j]][j] for j in range(n + 1)]
            backs.append(back)
        at = max(range(n + 1), key=lambda j: (score[j], -j))
        later = 0  # lines of the conversation in later partitions
        for k in range(len(chain) - 1, -1, -1):
            pid, goes_on = chain[k]["pid"], k < len(chain) - 1
            before = backs[k][at]
            old = ends[pid]
            ends[pid] = (before if k else old[0], at if goes_on and at < n else old[1], later > 0 or old[2])
            later += chain[k]["lines"]
            at = before
    return ends


def parse(rows: DataFrame, model: Model, conversation: str = "conv_id", position: str = "turn") -> DataFrame:
    """Runs of ``ordered`` rows: ``(conversation, position, part, role,
    opens_turn, n_lines, text, rendered)``."""
    ends = cuts(rows, model)  # one entry for each partition
    sent = rows.sparkSession.sparkContext.broadcast(ends)
    types = {f.name: f.dataType.simpleString() for f in rows.schema}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, goes_on = sent.value.get(TaskContext.get().partitionId(), (len(ROLES), None, False))
        batches = iter(batches)
        head = next(batches, None)
        if head is None:
            return
        kinds = [head.column(0).type, head.column(1).type, *[pa.int64(), pa.string(), pa.bool_(), pa.int64()],
                 pa.string(), pa.string()]
        held, size = [], 0

        def whole():
            yield head
            yield from batches

        def batch():
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in held], t) for i, t in enumerate(kinds)],
                                              names=names)

        waiting = None  # a conversation is decoded when the next one begins
        for c, part in groupby(fragments(whole()), key=lambda x: x[0]):
            if waiting:
                held += runs(model, *waiting, first, None, False)
                first = len(ROLES)
                size = sum(len(x[7]) for x in held) if len(held) > 256 else 0
                if size > 1 << 22 or len(held) > 4096:
                    yield batch()
                    held = []
            waiting = (c, list(part))
        held += runs(model, *waiting, first, last, goes_on)
        yield batch()

    names = [conversation, position, "part", "role", "opens_turn", "n_lines", "text", "rendered"]
    kind = (f"`{conversation}` {types['c']}, `{position}` {types['p']}, part long, role string, opens_turn boolean, "
            "n_lines long, text string, rendered string")
    return map_rows(rows, task, kind)


def runs(model: Model, c, part: list[tuple], before: int, after: int | None, goes_on: bool) -> list[tuple]:
    """The output rows of one conversation's fragments inside a partition."""
    at = [(p, k, line, i) for i, (_, p, text, _) in enumerate(part) for k, line in enumerate(lines_of(text))]
    states = model.decode([model.emission(line) for _, _, line, _ in at], before, after)
    out: list[list] = []
    open_ = before < len(ROLES)
    fragment = None
    for (p, _, line, i), state in zip(at, states):
        role, opens = ROLES[state // 2], state % 2 == 0
        if opens:
            cut = model.marked(line, state // 2)
            if cut:
                line = line[cut:] or None  # a marker on a line of its own
        if opens or fragment != i:
            lead = (CLOSE if open_ else "") + f"{OPEN}{role}\n" if opens else "\n"
            out.append([c, p, 0 if fragment != i else out[-1][2] + 1, role, opens, 0, [], lead])
        out[-1][5] += 1
        if line is not None:
            out[-1][6].append(line)
        open_, fragment = True, i
    for k, x in enumerate(out):
        x[6] = "\n".join(x[6])
        x[7] += x[6] + (CLOSE if k == len(out) - 1 and not goes_on else "")
    return [tuple(x) for x in out]


# -- transcripts of a table of messages --------------------------------------------

# How speakers are marked in the transcripts made here: one style a conversation.
STYLES = (
    {"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
    {"system": "Instructions: ", "user": "Human: ", "assistant": "AI: "},
    {"system": "### System:\n", "user": "### Instruction:\n", "assistant": "### Response:\n"},
    {"system": "[SYS] ", "user": "[USER] ", "assistant": "[BOT] "},
    {"system": "<|system|>\n", "user": "<|user|>\n", "assistant": "<|assistant|>\n"},
)
UNMARKED = 8              # every so many messages, by hash, one goes without a marker


def transcripts(messages: DataFrame, conversation: str = "conv_id", position: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """``(conversation, position, role, text)`` with the speaker's marker written
    into the text, in a style chosen by a hash of the conversation; some messages
    get none, as in transcripts found in the wild."""
    pick = lambda n, *c: F.crc32(F.concat_ws("/", *[F.coalesce(F.col(x).cast("string"), F.lit("")) for x in c])
                                 .cast("binary")) % F.lit(n)
    style = F.element_at(F.array(*[F.create_map(*[F.lit(x) for kv in s.items() for x in kv]) for s in STYLES]),
                         (pick(len(STYLES), conversation) + 1).cast("int"))
    marker = F.when(pick(UNMARKED, conversation, position) == 0, F.lit("")).otherwise(
        F.coalesce(F.try_element_at(style, F.coalesce(F.col(role), F.lit(""))), F.lit("")))
    return messages.select(F.col(conversation), F.col(position), F.col(role),
                           F.concat(marker, F.col(text)).alias(text))
