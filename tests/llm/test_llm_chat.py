"""Chat formatting: Viterbi against enumeration, cuts, rendering, accuracy."""

import itertools
import os

import pytest
from pyspark.sql import functions as F

from quire.llm import chat as C
from quire.llm.common import held_out, read_table

ROWS = "conv_id long, turn long, role string, text string"


def talks():
    rows = []
    for c in range(40):
        if c % 4 == 0:
            rows.append((c, 0, "system", "Be kind. Answer in one line."))
        for t in range(1, 2 + c % 5):
            role = "user" if t % 2 else "assistant"
            rows.append((c, t, role, "what is it? tell me" if role == "user" else
                         "It is this.\n- first point\n- second point\n\nThat is all."))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    df = spark.createDataFrame(talks(), ROWS)
    return C.fit(C.ordered(C.transcripts(df), role=F.col("role")))


def score(model, emissions, states):
    total, before = 0.0, None
    for e, s in zip(emissions, states):
        role, opens = s // 2, s % 2 == 0
        if before is None:
            total += model.start[role] if opens else C.NEVER
        elif opens:
            total += model.turn[before][role]
        else:
            total += model.on[role] if role == before else C.NEVER
        total += e[s]
        before = role
    return total


def test_viterbi_is_the_best_of_all_paths(model):
    lines = ["User: hi", "", "### Response:", "It is this.", "- first point"]
    for n in range(1, 6):
        emissions = [model.emission(x) for x in lines[:n]]
        best = max(score(model, emissions, p) for p in itertools.product(range(6), repeat=n))
        got = score(model, emissions, model.decode(emissions, len(C.ROLES), None))
        assert abs(got - best) < 1e-9


def test_transfer_matrices_compose(model):
    emissions = [model.emission(x) for x in ["User: hi", "what?", "Assistant: It is", "- a", "ok", "[USER] so"]]
    whole, a, b = model.transfer(emissions), model.transfer(emissions[:2]), model.transfer(emissions[2:])
    for i in range(4):
        for j in range(4):
            best = max(a[i][k] + b[k][j] for k in range(4))
            assert best == whole[i][j] or abs(best - whole[i][j]) < 1e-9
    assert model.transfer([]) == [[0.0 if i == j else C.NEVER for j in range(4)] for i in range(4)]


def test_partition_cuts_change_nothing(spark, model):
    """One conversation of most rows over many partitions."""
    rows = [(c % 2 if c < 30 else c, 10 * c + t, r, x) for c, t, r, x in talks()] + [(1, 5, None, None), (1, 6, None, "")]
    df = C.transcripts(spark.createDataFrame(rows, ROWS))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        parts = C.ordered(df)
        got = [tuple(r) for r in C.parse(parts, model).orderBy("conv_id", "turn", "part").collect()]
        assert parts.rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = []
    rows = sorted([tuple(r) for r in parts.collect()], key=lambda r: (r[0], r[1], r[2] or ""))
    for c, part in itertools.groupby(rows, key=lambda r: r[0]):
        want += C.runs(model, c, list(part), len(C.ROLES), None, False)
    assert got == want


def test_copies_of_one_row_spread(spark, model):
    """One message repeated more than anything else: many partitions, one result."""
    rows = [(7, 1, "user", "what is it?")] * 300 + [(8, 1, "user", "hi")]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = C.ordered(C.transcripts(spark.createDataFrame(rows, ROWS).repartition(5)))
        sizes = parts.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 200
        got = C.parse(parts, model).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(got) == 301 and sum(r.rendered.count("<|im_end|>") for r in got if r.conv_id == 7) == \
        sum(r.opens_turn for r in got if r.conv_id == 7)


def test_rendering_is_canonical(spark, model):
    rows = [(1, 0, "x", "System: Be kind.\nUser: what is it?\ntell me\nAssistant: It is this."),
            (2, 0, "x", "### Instruction:\nwhat is it?\n### Response:\nIt is this."), (2, 1, "x", "- second point")]
    parts = C.ordered(spark.createDataFrame(rows, ROWS))
    found = C.parse(parts, model).orderBy("conv_id", "turn", "part").collect()
    text = {c: "".join(r.rendered for r in found if r.conv_id == c) for c in (1, 2)}
    assert text[1] == ("<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>user\nwhat is it?\ntell me<|im_end|>\n"
                       "<|im_start|>assistant\nIt is this.<|im_end|>\n")
    assert text[2] == ("<|im_start|>user\nwhat is it?<|im_end|>\n"
                       "<|im_start|>assistant\nIt is this.\n- second point<|im_end|>\n")


def test_edge_rows(spark, model):
    rows = [(None, None, None, None), (None, 1, "user", ""), (3, None, "odd", "User: a"), (3, None, "odd", "User: a"),
            (4, 1, "user", "x\n" * 20_000)]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], ROWS + ", rendered string, p int")
    parts = C.ordered(C.transcripts(df), role=F.col("role"))
    got = C.parse(parts, model).collect()
    assert sum(r.n_lines for r in got) == 1 + 2 + 20_001
    empty = C.ordered(C.transcripts(df.limit(0)), role=F.col("role"))
    blank = C.fit(empty)
    assert C.parse(empty, blank).collect() == [] and len(set(blank.start)) == 1


def test_held_out_roles(spark):
    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("driver tables absent")
    messages = C.transcripts(read_table(spark, sf, "conversations"))
    parts = C.ordered(messages, role=F.when(~held_out(F.col("conv_id")), F.col("role")))
    found = C.parse(parts, C.fit(parts)).where("part = 0").withColumnRenamed("role", "got")
    both = found.join(messages, ["conv_id", "turn"]).where(held_out(F.col("conv_id")))
    n, right = both.agg(F.count(F.lit(1)), F.count_if(F.col("got") == F.col("role"))).first()
    assert n > 50 and right / n > 0.85


def rendered(spark, model, rows):
    parts = C.ordered(spark.createDataFrame(rows, ROWS))
    return "".join(r.rendered for r in C.parse(parts, model).orderBy("conv_id", "turn", "part").collect())


def test_rare_speakers_among_many_content_words(spark):
    """2,000 words before a colon in content, each seen more often than a speaker marker."""
    keys = ["k" + "".join(x) for x in itertools.product("abcdefghijklmn", repeat=3)][:2000]
    rows = []
    for c in range(40):
        asks, tells = ("Customer", "Agent") if c % 10 == 0 else ("User", "Assistant")
        body = "\n".join(f"{k}: {c}" for j in range(5) for k in keys[(c * 50 + j * 400) % 2000:][:250])
        rows += [(c, 1, "user", f"{asks}: what is it? tell me"), (c, 2, "assistant", f"{tells}: It is this.\n{body}"),
                 (c, 3, "user", f"{asks}: and then?")]
    model = C.fit(C.ordered(spark.createDataFrame(rows, ROWS), role=F.col("role")))
    assert model.markers == {"user", "assistant", "customer", "agent"}
    # what is no speaker marker is counted, not dropped: it goes on with a turn
    pooled = dict(zip(range(6), model.other[0]))
    assert max(pooled, key=pooled.get) == 5 and pooled[5] > 0
    got = rendered(spark, model, [(1, 1, None, "Customer: what is it?\nAgent: It is this.\nkaab: 1\nunseen: 2\nkaac: 3"),
                                  (1, 2, None, "Customer: and then?")])
    assert got == ("<|im_start|>user\nwhat is it?<|im_end|>\n<|im_start|>assistant\nIt is this.\nkaab: 1\nunseen: 2\n"
                   "kaac: 3<|im_end|>\n<|im_start|>user\nand then?<|im_end|>\n")


def test_unseen_marker_favours_no_state(model):
    assert len({round(x, 9) for x in C.Model({("see", 0, "", s): 10 ** s for s in range(6)}).other[0]}) == 1


def test_content_words_before_a_colon_stay(spark):
    """Round trip of turns that open, unmarked or after a marker, with 'Note:' or a link."""
    said = {"user": ["Note: shall I bring it?", "what is it? tell me why?", "https://example.org/a is down?"],
            "assistant": ["It is this.\nNote: mind the step.\nhttps: is a word.", "Question: that is one of the many.",
                          "https://example.org/b is the place to look at."]}
    rows = [(c, t, "user" if t % 2 else "assistant", said["user" if t % 2 else "assistant"][(c + t // 2) % 3])
            for c in range(60) for t in range(1, 5)]
    messages = spark.createDataFrame(rows, ROWS)
    marked = C.transcripts(messages)
    unmarked = marked.join(messages, ["conv_id", "turn", "text"])
    assert unmarked.where("text LIKE 'Note:%'").count() and unmarked.where("text LIKE 'https:%'").count()
    parts = C.ordered(marked, role=F.col("role"))
    model = C.fit(parts)
    assert {"user", "assistant"} <= model.markers and not model.markers & {"note", "question", "https"}
    got = {}
    for r in C.parse(parts, model).orderBy("conv_id", "turn", "part").collect():
        got.setdefault((r.conv_id, r.turn), []).append(r.text)
    assert {k: "\n".join(x) for k, x in got.items()} == {r[:2]: r[3] for r in rows}


def test_only_a_marker_of_the_role_is_cut(spark):
    rows = [(c, t, r, f"{m}: {x}") for c in range(9) for t, r, m, x in
            ((1, "user", "Human", "what is it?"), (2, "assistant", "AI", "It is this."))]
    rows += [(c, 3, "user", "https://example.org") for c in range(9)] + [(1, 4, "assistant", "Aside: It is that.")]
    model = C.fit(C.ordered(spark.createDataFrame(rows, ROWS), role=F.col("role")))
    assert model.markers == {"human", "ai"}
    assert model.marked("Human: x", 1) == 7 and model.marked("Human: x", 2) == 0
    assert all(model.marked(x, r) == 0 for x in ("Aside: x", "https://example.org", "Note: x", "x") for r in range(3))
