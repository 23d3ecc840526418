from pyspark.sql import functions as F

from waybill.llm import preference

U, A, S = "user", "assistant", "system"
TALKS = {
    0: [(S, "be kind"), (U, "hi"), (A, "hello"), (U, "bye")],
    1: [(U, "hi"), (A, "hey"), (U, "more"), (A, "hello")],
    2: [(U, "no reply")],
    3: [(U, "q"), (A, "r")],
    4: [(U, "q"), (A, "x" * 200000)],
    5: [(None, None), (A, None)],
    None: [(U, "lost"), (A, "found")],
}


def written(turns):
    return "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in turns)


def mask(turns):
    out = []
    for role, text in turns:
        head, body = len(f"<|im_start|>{role or ''}\n"), len(f"{text or ''}<|im_end|>\n")
        out += [f"{head}:0", f"{body}:1"] if role == A else [f"{head + body}:0"]
    return ",".join(out)


def want(talks):
    plain = {c: [(r or "", t or "") for r, t in turns] for c, turns in talks.items()}
    last = {c: max((i for i, (r, _) in enumerate(t) if r == A), default=None) for c, t in plain.items()}
    out = {}
    for c, turns in plain.items():
        other = "nobody" if c is None else c ^ 1
        if last[c] is None:
            rejected = turns
        else:
            rejected = turns[: last[c]]
            if other in plain and last[other] is not None:
                rejected = [*rejected, plain[other][last[other]]]
        n = 0
        while n < min(len(turns), len(rejected)) and turns[n] == rejected[n]:
            n += 1
        a, b = turns[n:], rejected[n:]
        out[c] = (n, written(turns[:n]), written(a), written(b), mask(a), mask(b), bool(a or b))
    return out


def test_pairs_against_plain_python(spark):
    rows = [(c, i, r, t) for c, turns in TALKS.items() for i, (r, t) in enumerate(turns)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = turns.withColumns({"turns": F.lit(1), "chosen": F.lit("c"), "prompt": F.lit(0)}).orderBy(F.rand(3))
    got = preference.examples(preference.with_foreign_reply(turns))
    kept = ("n_prompt_turns", "prompt", "chosen", "rejected", "chosen_mask", "rejected_mask", "differs")
    assert {r.conv_id: tuple(r[k] for k in kept) for r in got.collect()} == want(TALKS)
    assert preference.examples(preference.with_foreign_reply(turns.limit(0))).count() == 0


def test_given_pairs(spark):
    turns = "array<struct<role:string,text:string>>"
    pairs = spark.createDataFrame(
        [(1, [(U, "a"), (A, "b")], [(U, "a"), (A, "c"), (U, "d")]), (2, None, [(U, "a")]), (3, [], None)],
        f"pair int, chosen {turns}, rejected {turns}",
    )
    rows = {r.pair: r for r in preference.examples(pairs).collect()}
    assert rows[1].n_prompt_turns == 1 and rows[1].chosen == written([(A, "b")])
    assert [s.trained for s in rows[1].rejected_segments] == [False, True, False]
    assert rows[2].chosen == "" and rows[2].rejected == written([(U, "a")]) and rows[2].differs
    assert not rows[3].differs


def test_repeated_and_unordered_turns(spark):
    rows = [(7, 1, A, "b"), (7, None, U, "z"), (7, 1, A, "b"), (7, 1, A, "a"), (7, 0, U, "q")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert [t.text for t in preference.conversations(turns).first().turns] == ["z", "q", "a", "b", "b"]
