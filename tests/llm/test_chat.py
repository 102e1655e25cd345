from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import SMALL, table
from millrace.llm.chat import CONTROL, digests, escaped, log_of, messages, rendered, unescaped
from millrace.llm.queries import QUERIES, TRICKY

LOG = "conv_id bigint, seq bigint, kind string, turn bigint, role string, text string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows: list[tuple]) -> dict:
    by_id: dict = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1])):
        by_id.setdefault(conv, []).append((role, text or ""))
    found = {}
    for conv, said in by_id.items():
        learned = "".join(t for r, t in said if r == "assistant")
        found[conv] = (len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)), len(learned), sha(learned))
    return found


def test_query_equals_brute_force(spark):
    rows = QUERIES["op3_chat_formatting"](spark, SMALL).collect()
    assert {r[0]: tuple(r)[1:5] for r in rows} == expected([*table("conversations"), *TRICKY])


def test_events_are_folded(spark):
    log = [
        (1, 1, "start", 0, "user", None), (1, 2, "delta", 0, None, "Hel"), (1, 3, "delta", 0, None, "lo"),
        (1, 4, "start", 1, "assistant", None), (1, 5, "delta", 1, None, "bad"), (1, 6, "start", 2, "user", "lost"),
        (1, 7, "regenerate", 1, None, None), (1, 8, "start", 1, "assistant", None), (1, 9, "delta", 1, None, "good"),
        (2, 1, "start", 0, "user", "one"), (2, 2, "edit", 0, None, "two"), (2, 3, "delta", 0, None, "!"),
        (3, 1, None, None, "user", "x"), (None, 1, "start", 0, "user", "y"), (4, 1, "start", 0, "user", None),
    ]
    frame = spark.createDataFrame(log, LOG)
    found = sorted(map(tuple, messages(frame).collect()), key=repr)
    assert found == sorted(
        [(1, 0, "user", "Hello"), (1, 1, "assistant", "good"), (2, 0, "user", "two!"), (3, None, "user", "x"),
         (None, 0, "user", "y"), (4, 0, "user", None)], key=repr,
    )
    assert messages(frame.limit(0)).count() == 0 and rendered(messages(frame.limit(0))).count() == 0


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*CONTROL, "\\", "<", "[", "a", "\n", "漢"]), max_size=8).map("".join), min_size=1, max_size=20))
def test_escaping_is_reversible_and_leaves_no_control_string(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, e, u in frame.select("t", escaped(F.col("t")).alias("e")).select("t", "e", unescaped(F.col("e"))).collect():
        assert u == t and not any(c in e for c in CONTROL)


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "no turn"), (1, 1, "assistant", "a" * 200_000), (None, 0, "assistant", "")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, seq int")
    found = {r["conv_id"]: r for r in digests(rendered(messages(log_of(frame)))).collect()}
    assert found[1]["n_turns"] == 4 and found[1]["loss_chars"] == 200_000
    assert found[1]["turns_sha256"] == sha("\nno turn\n" + "user\n\n" * 2 + "assistant\n" + "a" * 200_000 + "\n")
    assert found[None]["n_turns"] == 1 and found[None]["loss_chars"] == 0


def test_the_log_holds_edits_regenerations_and_deltas_that_fold_to_its_rows(spark):
    said = [(1, t, ("user", "assistant")[t % 2], f"message {t} \u6f22\U0001f600" * (t % 5)) for t in range(13)] + [(2, None, None, None), (2, None, "user", "")]
    rows = spark.createDataFrame(said, "conv_id bigint, turn bigint, role string, text string")
    log = log_of(rows)
    kinds = {r["kind"]: r["count"] for r in log.groupBy("kind").count().collect()}
    assert kinds["regenerate"] == 3 + 1 and kinds["edit"] == 4 and kinds["delta"] > 3 * len(said) and kinds["start"] > len(said)
    found = sorted(((r["conv_id"], r["turn"], r["role"], r["text"]) for r in messages(log.repartition(5)).collect()), key=repr)
    order = sorted(said, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] is not None))
    place: dict = {}
    wanted = []
    for conv, _, role, text in order:
        place[conv] = place.get(conv, 0) + 1
        wanted.append((conv, place[conv], role, text or ""))
    assert found == sorted(wanted, key=repr)
