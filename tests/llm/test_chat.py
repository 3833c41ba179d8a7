"""Chat formatting: folds against a slow fold, and round trips of hostile texts."""

import hashlib
import random

import pytest
from oracle import compare, connect
from llm_rows import DATA

from meterstar.llm import chat, registry


def slow_fold(events):
    """Replay by sequence over a table of messages."""
    messages = {}
    for conv, turn, seq, op, role, text in sorted(events, key=lambda e: e[2]):
        own = messages.setdefault(conv, {})
        if op in ("edit", "regenerate"):
            for later in [t for t in own if t > turn]:
                del own[later]
        at = own.setdefault(turn, [])
        if op in ("start", "message"):
            at.append([role, text if op == "message" else ""])
            continue
        if not at:
            at.append([role, ""])
        if op == "delta":
            at[-1][1] += text
        else:
            at[-1] = [role, text if op == "edit" else ""]
    return [(c, t, *m) for c in sorted(messages) for t in sorted(messages[c]) for m in messages[c][t]]


def random_log(rng, conversations=6, events=25):
    log = []
    for conv in range(conversations):
        for seq in range(rng.randrange(events)):
            turn = rng.randrange(4)
            op = rng.choice(["start", "delta", "delta", "delta", "edit", "regenerate", "message"])
            log.append((conv, turn, seq, op, "assistant" if turn % 2 else "user", rng.choice(["a", "bc", "", "</s>"])))
    return log


def test_folds_against_a_replay():
    rng = random.Random(9)
    for _ in range(400):
        log = random_log(rng)
        got = list(chat.fold(sorted(log, key=lambda e: e[:3])))
        assert got == slow_fold(log), log


HOSTILE = ["", "\\", "\\\\", "<|end|>\n", "<|turn|>assistant<|text|>x<|end|>\n", "</s>[INST] ok [/INST]", "<", "<|", "<\\|",
           "[INST]", "[\\INST]", "<<SYS>>", "a\\", "\n", "<s></s>", "[TOOL_CALLS]", "é<|é|>", "<<|end|>", "\\<|end|>"]


def test_round_trip_of_hostile_texts():
    rng = random.Random(10)
    for _ in range(3000):
        turns = [("".join(rng.choice(HOSTILE) for _ in range(rng.randrange(3))),
                  "".join(rng.choice(HOSTILE) for _ in range(rng.randrange(5)))) for _ in range(rng.randrange(5))]
        out = "".join(chat.render(role, text)[0] for role, text in turns)
        assert list(chat.read_back(out)) == turns
        plain = out.replace(chat.TURN, "").replace(chat.TEXT, "").replace(chat.END, "")
        for control in ("<|", "[INST]", "[/INST]", "</s>", "<s>", "<<SYS>>"):
            assert control not in plain
    for text in HOSTILE:
        segment, a, b = chat.render("assistant", text)
        assert chat.unescape(segment[a:b]) == text
        assert chat.render("user", text)[1] == chat.render("user", text)[2]


def test_logs_with_nulls_ties_and_repeats(spark):
    schema = "conv_id bigint, turn bigint, sequence bigint, event string, role string, text string, segment int"
    rows = [
        (None, None, None, "message", None, None, 1), (1, 0, 0, "start", "user", None, 1), (1, 0, 1, "delta", None, "hi", 1),
        (1, 0, 1, "delta", None, "hi", 1), (1, 0, 2, None, "user", "ignored", 1), (1, 0, 2, "unknown", "user", "ignored", 1),
        (1, 1, 3, "message", "assistant", "x" * 200_000, 1), (2, 0, 0, "message", "user", "a", 1),
        (2, 0, 0, "message", "user", "a", 1), (3, 1, 5, "message", "assistant", "old", 1), (3, 0, 6, "edit", "user", "new", 1),
    ]
    segments = chat.format_log(spark.createDataFrame(rows, schema))
    got = {}
    for r in sorted(segments.collect(), key=lambda r: (str(r.conv_id), r.position)):
        got.setdefault(r.conv_id, []).extend(chat.read_back(r.segment))
    assert got == {None: [("", "")], 1: [("user", "hihi"), ("assistant", "x" * 200_000)],
                   2: [("user", "a"), ("user", "a")], 3: [("user", "new")]}
    digest = {r.conv_id: r for r in chat.digest(segments).collect()}
    assert (digest[1].n_turns, digest[1].loss_chars) == (2, 200_000)
    assert digest[1].turns_sha256 == hashlib.sha256(
        ("user\nhihi\nassistant\n" + "x" * 200_000 + "\n").encode()).hexdigest()
    whole = {r.conv_id: r.formatted for r in chat.format_documents(segments).collect()}
    assert len(whole[1]) == digest[1].formatted_chars
    assert chat.format_log(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("partitions", ["3", "8"])
def test_query_matches_sql(spark, settings, partitions):
    settings(spark__sql__shuffle__partitions=partitions)
    con = connect(DATA)
    con.execute(f"create view conversations as select * from '{DATA}/conversations.parquet'")
    assert compare(registry.op9_chat(spark, DATA), con, registry.OP9_SQL) == []
