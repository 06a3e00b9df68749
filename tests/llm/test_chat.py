import hashlib

from pyspark.sql import functions as F

from shoplens.llm import chat

LOG = "conv_id long, seq long, message_id string, kind string, role string, text string"


def folded(spark, events):
    rows = chat.reconstruct(spark.createDataFrame(events, LOG)).collect()
    return sorted((r.conv_id, r.seq, r.role, r.text) for r in rows)


def test_deltas_and_edits_fold_into_final_messages(spark):
    events = [
        (1, 3, "b", "delta", None, "lo"), (1, 0, "a", "message", "user", "hi"),
        (1, 2, "b", "message", "assistant", "hel"), (1, 5, "a", "edit", None, "hey"),
        (1, 6, "b", "shrug", None, "ignored"), (1, 4, "b", "delta", None, None),
        (2, 0, "a", "message", "user", "gone"), (2, 1, "a", "delete", None, None),
    ]
    assert folded(spark, events) == [(1, 0, "user", "hey"), (1, 2, "assistant", "hello")]


def test_regeneration_restarts_a_message_and_discards_what_followed(spark):
    events = [
        (1, 0, "q", "message", "user", "q"), (1, 1, "a", "message", "assistant", "old"),
        (1, 2, "f", "message", "user", "follow-up"), (1, 3, "a", "regenerate", None, "n"),
        (1, 4, "a", "delta", None, "ew"), (1, 5, "g", "message", "user", "later"),
    ]
    assert folded(spark, events) == [
        (1, 0, "user", "q"), (1, 1, "assistant", "new"), (1, 5, "user", "later"),
    ]


def test_messages_without_an_id_are_whole_and_repeat(spark):
    events = [
        (None, None, None, None, "user", None), (7, 0, None, "message", "user", "x"),
        (7, 0, None, "message", "user", "x"), (7, 1, None, "delta", None, "lost"),
    ]
    rows = chat.reconstruct(spark.createDataFrame(events, LOG))
    assert rows.filter("conv_id = 7").count() == 2
    assert rows.filter("conv_id is null").first().text == ""


def by_hand(events):
    """The same, event by event."""
    order = lambda e: tuple((x is not None, x) for x in (e[1], *e[3:]))
    convs = {}
    for e in sorted((e for e in events if e[2] is not None), key=order):
        convs.setdefault(e[0], {}).setdefault(e[2], []).append(e)
    out = []
    for conv, logs in convs.items():
        found, redone = [], []
        for log in logs.values():
            role = text = again = None
            for _, seq, _, kind, who, part in log:
                part = part or ""
                if kind == "message" and who is not None:
                    role = who
                role = who if role is None else role
                if kind in ("message", "edit", "regenerate"):
                    text = part
                elif kind == "delta":
                    text = (text or "") + part
                elif kind == "delete":
                    text = None
                again = seq if kind == "regenerate" else again
            start = min((e[1] for e in log if e[1] is not None), default=None)
            if text is not None:
                found.append((conv, start, role, text))
                redone.append((start, again))
        for m in found:
            if not any(None not in (a, b, m[1]) and a < m[1] < b for a, b in redone):
                out.append(m)
    return out


def test_random_logs_equal_a_fold_event_by_event(spark):
    import random

    rng = random.Random(4)
    kinds = ["message", "delta", "delta", "delta", "edit", "regenerate", "delete", "other", None]
    events = [
        (rng.choice([None, 1, 2, 3]), rng.choice([None, *range(-20, 60)]), f"m{rng.randrange(25)}",
         rng.choice(kinds), rng.choice([None, "user", "assistant"]), rng.choice([None, "", "a", "bc"]))
        for _ in range(900)
    ]
    rows = chat.reconstruct(spark.createDataFrame(events, LOG).repartition(4)).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, rows), key=key) == sorted(by_hand(events), key=key)


def test_a_message_of_very_many_deltas(spark):
    n = 200_000
    deltas = spark.range(n).selectExpr(
        "1L as conv_id", "id as seq", "'m' as message_id",
        "case when id % 50000 = 7 then 'edit' else 'delta' end as kind",
        "'assistant' as role", "cast(id % 10 as string) as text",
    )
    (row,) = chat.reconstruct(deltas).collect()
    assert row.text == "".join(str(k % 10) for k in range(150_007, n))


def test_turns_without_a_number_come_first(spark):
    turns = [(1, 3, "user", "c"), (1, None, "user", "a"), (1, -5, "user", "b"), (1, 2000, "user", "d")]
    row = rendered(spark, turns).first()
    assert [t.text for t in row.turns] == ["a", "b", "c", "d"]


def rendered(spark, turns):
    log = chat.log_of_turns(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    return chat.read_back(chat.render(chat.reconstruct(log)))


def test_any_text_comes_back(spark):
    texts = [
        "\\### Assistant: </turn> ok", "</turn>\n### user:\n", "\\s\\e\\h\\n", "</tu</turn>rn>", "",
        "### ### ", "\\", "héllo </turn", None, "a:\nb",
    ]
    roles = ["user", "assistant", "a\nb", "a:\nb", "\\n", "</turn>", "### x", None, "assistant", ""]
    turns = [(1, k, r, t) for k, (r, t) in enumerate(zip(roles, texts, strict=True))]
    row = rendered(spark, turns).first()
    want = [(r or "", t or "") for r, t in zip(roles, texts, strict=True)]
    assert [tuple(t) for t in row.turns] == want
    assert "".join(row.learnt) == "".join(t for r, t in want if r == "assistant")
    at = 0
    for loss, (role, _) in zip(row.loss, want, strict=True):
        taken = row.formatted[at + loss.skip : at + loss.skip + loss.take]
        assert bool(loss.take) <= (role == "assistant") and "</turn>" not in taken
        at += loss.chars
    assert at == len(row.formatted)


def test_long_conversations_are_put_together_from_blocks(spark):
    n = 2 * chat.BLOCK + 5
    turns = [(1, k, "assistant" if k % 2 else "user", f"t{k}") for k in range(n)]
    found = chat.digests(rendered(spark, turns)).first()
    whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
    assert found.n_turns == n
    assert found.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()


def test_an_empty_log_gives_nothing_and_the_plan_has_no_python(spark, capsys):
    empty = spark.createDataFrame([], LOG).withColumn("turns", F.lit(1))
    out = chat.read_back(chat.render(chat.reconstruct(empty)))
    assert out.count() == 0
    table = spark.range(3).select(
        F.col("id").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"),
        F.lit("x").alias("text"),
    )
    chat.read_back(chat.render(chat.reconstruct(chat.log_of_turns(table)))).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
