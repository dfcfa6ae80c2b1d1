"""Chat sequences: exact round trips, what is shared, and what each turn sees."""

import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from compare import differences, tables_of
from plumbline.llm import chat
from plumbline.llm.registry import ORACLES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, turns int, path string"
BITS = ["\\", "<", "|", "im_start", "im_end", "|>", "<s>", "</s>", "[", "/", "INST]", "\n", "a", "é", "<|endoftext|>"]


@given(st.lists(st.sampled_from(BITS), max_size=12).map("".join))
@settings(max_examples=400, deadline=None)
def test_escaped_text_holds_no_control_string_and_comes_back(text):
    escaped = chat.escape(text)
    assert not any(control in escaped for control in chat.CONTROL_STRINGS)
    assert chat.unescape(escaped) == text
    role = text[::-1]
    formatted = f"{chat.TURN_START}{chat._header(role)}{escaped}{chat.TURN_END}\n"
    assert chat.turns_of(formatted * 2) == [(role, text)] * 2


def test_what_is_no_conversation_is_an_error():
    for text in ("x", chat.TURN_START, f"{chat.TURN_START}user\nno end", f"{chat.TURN_START}user{chat.TURN_END}\n"):
        with pytest.raises(ValueError):
            chat.turns_of(text)


def conversations(spark, rows):
    return spark.createDataFrame([(*row, 1, "x") for row in rows], SCHEMA)


def tree_rows():
    """Conversations that share their first turns: 1 and 2 all, 3 two of them, 4 one, 5 none."""
    first, answer = ("system", "be <s>brief"), ("assistant", "yes\\")
    turns = {
        1: [first, ("user", "hello"), answer],
        2: [first, ("user", "hello"), answer],
        3: [first, ("user", "hello"), ("assistant", "no")],
        4: [first, ("user", "bye"), answer],
        5: [("user", "hello"), answer],
    }
    return [(c, k, *turn) for c, own in turns.items() for k, turn in enumerate(own)]


def test_shared_turns_stand_once(spark):
    rows = chat.sequences(conversations(spark, tree_rows()).coalesce(1), chat.tokenizer_path()).collect()
    assert sum(len(r.turns) for r in rows) >= 8  # the distinct beginnings
    whole = [r for r in rows if len(r.conversations) > 1]
    for row in whole:
        assert row.token_ids and len(row.token_ids) == len(row.position_ids) == len(row.loss_mask)
        ends = 0
        for n, turn in enumerate(row.turns):
            assert turn.start == ends and turn.parent < n
            ends = turn.end
            above, seen = turn.parent, set()
            while above >= 0:
                seen |= set(range(row.turns[above].start, row.turns[above].end))
                above = row.turns[above].parent
            assert {k for s in turn.sees for k in range(s.start, s.end)} == seen
            assert row.position_ids[turn.start] == len(seen)
        assert ends == len(row.token_ids)


def plain_tree(rows):
    """Turns of the prefix tree over all conversations."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        own[conv_id].append((turn, role, text))
    return {tuple(t[1:] for t in sorted(turns)[: k + 1]) for turns in own.values() for k in range(len(turns))}


def test_one_task_writes_each_turn_of_the_tree_once(spark):
    rows = [
        (c, k, "assistant" if k % 2 else "user", f"say {c % (k + 2)} of {k}") for c in range(120) for k in range(1 + c % 6)
    ]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        found = chat.sequences(conversations(spark, rows), chat.tokenizer_path(), 1 << 20).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(found) == 1 and len(found[0].conversations) == 120
    assert len(found[0].turns) == len(plain_tree(rows))
    assert sum(found[0].loss_mask) < len(found[0].token_ids) / 2


def plain_row(turns):
    turns = [(role or "", text or "") for _, role, text in turns]
    learned = "".join(text for role, text in turns if role == "assistant")
    formatted = sum(
        len(f"{chat.TURN_START}{chat._header(role)}{chat.escape(text)}{chat.TURN_END}\n") for role, text in turns
    )
    said = "".join(f"{role}\n{text}\n" for role, text in turns)
    return (
        len(turns),
        hashlib.sha256(said.encode()).hexdigest(),
        len(learned),
        hashlib.sha256(learned.encode()).hexdigest(),
        formatted,
    )


def digests(rows):
    return {r.conv_id: tuple(r[1:]) for r in rows}


@pytest.mark.parametrize("most_tokens, most_conversations", [(8192, 1024), (60, 2), (1, 1)])
def test_small_sequences_lose_nothing(spark, most_tokens, most_conversations):
    path = chat.tokenizer_path()
    rows = tree_rows() * 2 + [(6, k, "assistant", "word " * k) for k in range(40)]
    trained = chat.sequences(conversations(spark, rows), path, most_tokens, most_conversations)
    if most_conversations < 3:
        assert max(len(r.conversations) for r in trained.collect()) <= most_conversations
    own = defaultdict(list)
    for conv_id, turn, role, text in sorted(rows):
        own[conv_id].append((role, text))
    found = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.read_back(trained, path).collect()}
    assert found == own


def test_query_against_its_sql_and_plain_python(spark, as_table):
    rows = tree_rows() + [
        (7, 0, "us\ner\\", "</s>[INST] ok [/INST]"),
        (8, 1, "assistant", None),
        (8, 0, None, "\\<|im_end|>\n<|im_start|>assistant\n"),
        (9, None, "assistant", "first"),
        (9, 3, "assistant", "same"),
        (9, 3, "assistant", "same"),
        (9, 3, "a", "😀 é"),
        (10, 0, "assistant", "long " * 20_000),
        *[(c, 0, "user", "a very common turn") for c in range(100, 400)],
        *[(c, 1, "assistant", f"answer {c % 3}") for c in range(100, 400)],
    ]
    table = conversations(spark, rows)
    folder = as_table(table.limit(0), conversations=table)
    found = chat.op12(spark, folder)
    assert differences(found, tables_of(folder), ORACLES["op12_chat_prefix_tree"]) is None
    own = defaultdict(list)
    for conv_id, turn, role, text in rows + [(-1, 0, "user", chat._PROBE), (-1, 1, "assistant", chat._PROBE)]:
        own[conv_id].append((turn if turn is not None else -1, role or "", text or ""))
    assert digests(found.collect()) == {c: plain_row(sorted(turns)) for c, turns in own.items()}


def test_rows_without_a_conversation_and_empty_tables(spark):
    path = chat.tokenizer_path()
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (None, 1, "assistant", "b"), (1, 0, "user", "a")]
    found = chat.read_back(chat.sequences(conversations(spark, rows), path), path).collect()
    assert sorted((r.conv_id is None, r.learned, len(r.turns)) for r in found) == [
        (False, "", 1),
        (True, "", 1),
        (True, "b", 1),
        (True, "b", 1),
    ]
    assert chat.read_back(chat.sequences(conversations(spark, []), path), path).count() == 0
