"""Conversations as training sequences in which shared beginnings stand once.

Conversations that begin with the same turns are paths of one prefix tree. A sequence holds part of
such a tree depth-first: each turn is written once, after the turn it follows. A token's
position counts along its own conversation, and each turn has the intervals of the sequence that
its tokens see besides their own turn, which are its ancestors'.

A conversation reads ``<|im_start|>role``, a line break, the text, ``<|im_end|>`` and a line break
for each turn. The two marks are tokens of their own, numbered on after the vocabulary. Control
strings in roles and texts are broken by a backslash, and backslashes are doubled.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.alignment import ByteLevel
from plumbline.llm.registry import query, table
from plumbline.llm.text import kept

TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"
# Strings that may steer a model, here or in other templates.
CONTROL_STRINGS = (TURN_START, TURN_END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")
# The role whose texts are learned.
LEARNED_ROLE = "assistant"

# A sequence is closed before it gets more tokens, unless by one conversation, or more conversations.
SEQUENCE_TOKENS = 8192
SEQUENCE_CONVERSATIONS = 1024

# Conversations lie together by so many of their first turns, and by all where tasks sort them.
PATH_TURNS = 16

Turn = tuple[str, str]  # role and text


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for control in CONTROL_STRINGS:
        text = text.replace(control, f"{control[0]}\\{control[1:]}")
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def _header(role: str) -> str:
    return escape(role).replace("\n", "\\\n") + "\n"


_TURN = re.compile(
    rf"{re.escape(TURN_START)}((?:\\.|[^\\\n])*)\n(.*?){re.escape(TURN_END)}\n", re.DOTALL
)


def turns_of(formatted: str) -> list[Turn]:
    """The turns of a formatted conversation."""
    found, at = [], 0
    for turn in _TURN.finditer(formatted):
        if turn.start() != at:
            break
        found.append((unescape(turn[1]), unescape(turn[2])))
        at = turn.end()
    if at != len(formatted):
        raise ValueError(f"no turn at character {at}")
    return found


class Template:
    """Tokens of turns, and text of tokens."""

    def __init__(self, path: str):
        self._vocabulary = ByteLevel(path)
        size = len(self._vocabulary.vocabulary.tokens)
        self._start, self._end = size, size + 1
        marks = np.array([TURN_START.encode(), TURN_END.encode()], dtype=object)
        self._bytes = np.concatenate([self._vocabulary.vocabulary.tokens, marks])

    def encode(self, turn: Turn) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and which of them are learned: those of a learned role's text alone."""
        role, text = turn
        header, body, end = self._vocabulary.ids([_header(role), escape(text), "\n"])
        ids = np.concatenate([[self._start], header, body, [self._end], end])
        learned = np.zeros(len(ids), dtype=bool)
        if role == LEARNED_ROLE:
            learned[1 + len(header) : 1 + len(header) + len(body)] = True
        return ids, learned

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(self._bytes[ids]).decode()


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_SEQUENCES = pa.schema(
    [
        ("sequence_id", pa.int64()),
        ("token_ids", pa.list_(pa.int32())),
        ("position_ids", pa.list_(pa.int32())),
        ("loss_mask", pa.list_(pa.bool_())),
        (
            "turns",
            pa.list_(
                pa.struct(
                    [("start", pa.int32()), ("end", pa.int32()), ("parent", pa.int32()), ("sees", pa.list_(_SPAN))]
                )
            ),
        ),
        ("conversations", pa.list_(pa.struct([("conv_id", pa.int64()), ("last_turn", pa.int32())]))),
    ]
)
_SEQUENCES_SQL = (
    "sequence_id bigint, token_ids array<int>, position_ids array<int>, loss_mask array<boolean>, "
    "turns array<struct<start: int, end: int, parent: int, sees: array<struct<start: int, end: int>>>>, "
    "conversations array<struct<conv_id: bigint, last_turn: int>>"
)


class Sequence:
    """A sequence that is being written. Conversations come in the order of their paths, so only the
    last one's turns can be shared with the next."""

    def __init__(self) -> None:
        self.size = 0
        self._ids: list[np.ndarray] = []
        self._positions: list[np.ndarray] = []
        self._learned: list[np.ndarray] = []
        self._turns: list[dict] = []
        self.conversations: list[dict] = []
        self._path: list[tuple[Turn, int, int]] = []  # turn, its number, the position after it

    def shared(self, turns: list[Turn]) -> int:
        """How many first turns stand in the sequence as those of the last conversation."""
        n = 0
        while n < min(len(turns), len(self._path)) and self._path[n][0] == turns[n]:
            n += 1
        return n

    def add(self, conv_id: int | None, turns: list[Turn], tokens: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """``tokens`` are those of the turns that are not shared."""
        del self._path[len(turns) - len(tokens) :]
        for turn, (ids, learned) in zip(turns[len(self._path) :], tokens, strict=True):
            parent, position, sees = -1, 0, []
            if self._path:
                _, parent, position = self._path[-1]
                above = self._turns[parent]
                sees = [dict(span) for span in above["sees"]]
                if sees and sees[-1]["end"] == above["start"]:
                    sees[-1]["end"] = above["end"]
                else:
                    sees.append({"start": above["start"], "end": above["end"]})
            end = self.size + len(ids)
            self._path.append((turn, len(self._turns), position + len(ids)))
            self._turns.append({"start": self.size, "end": end, "parent": parent, "sees": sees})
            self._ids.append(ids)
            self._positions.append(np.arange(position, position + len(ids)))
            self._learned.append(learned)
            self.size = end
        self.conversations.append({"conv_id": conv_id, "last_turn": self._path[-1][1]})

    def row(self, number: int) -> pa.RecordBatch:
        values = (
            number,
            np.concatenate(self._ids).astype(np.int32),
            np.concatenate(self._positions).astype(np.int32),
            np.concatenate(self._learned),
            self._turns,
            self.conversations,
        )
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip(values, _SEQUENCES, strict=True)], schema=_SEQUENCES
        )


def by_path(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns`` of each conversation, those that begin alike side by side.

    Partitions are ranges of the hashes of the first turns and of the id, so that any number of
    conversations with the same beginning, or of copies of one, spreads over tasks.
    """
    turn = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", turn.alias("said"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull(), "turn", "said")))
    whole = (
        rows.filter("conv_id is not null")
        .groupBy("conv_id")
        .agg(F.transform(ordered, lambda row: row["said"]).alias("turns"))
        .unionByName(rows.filter("conv_id is null").select("conv_id", F.array("said").alias("turns")))
    )
    path = F.aggregate(
        F.slice("turns", 1, PATH_TURNS),
        F.array().cast("array<bigint>"),
        lambda path, said: F.array_append(
            path, F.xxhash64(F.coalesce(F.try_element_at(path, F.lit(-1)), F.lit(0)), said)
        ),
    )
    ranged = whole.withColumn("path", path).repartitionByRange("path", "conv_id")
    return ranged.sortWithinPartitions("path", "turns", "conv_id").select("conv_id", "turns")


def sequences(
    conversations: DataFrame,
    tokenizer: str,
    most_tokens: int = SEQUENCE_TOKENS,
    most_conversations: int = SEQUENCE_CONVERSATIONS,
) -> DataFrame:
    """Training sequences of all conversations (``conv_id, turn, role, text``).

    A row is a sequence: ``token_ids``; ``position_ids``; ``loss_mask``, true for the texts of
    assistants; ``turns`` with their place (``start``, ``end``), the turn they follow (``parent``, -1
    for none) and the intervals that they see besides themselves (``sees``); ``conversations`` with
    the turn that ends each. A turn is written once in a sequence. Where a tree goes on in another
    sequence, the turns above are written there again, as their tokens have to be seen.

    Turns are ordered by ``turn``, nulls first, then by role and text; repeated rows are turns of
    their own. A null role or text is empty. A row without a ``conv_id`` belongs to no other: it is a
    conversation of one turn. A conversation over ``most_tokens`` has a sequence of its own and is
    never cut; a task holds one conversation and one sequence. An empty table gives no rows; other
    columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = kept(f"turns by {tokenizer}", lambda: Template(tokenizer))
        number, open_ = TaskContext.get().partitionId() << 33, Sequence()
        for batch in batches:
            for conv_id, turns in zip(batch.column(0), batch.column(1), strict=True):
                said = [(turn["role"], turn["text"]) for turn in turns.as_py()]
                fresh = [template.encode(turn) for turn in said[open_.shared(said) :]]
                full = open_.size + sum(len(ids) for ids, _ in fresh) > most_tokens
                if open_.conversations and (full or len(open_.conversations) >= most_conversations):
                    yield open_.row(number)
                    number, open_ = number + 1, Sequence()
                    shared = len(said) - len(fresh)
                    fresh = [template.encode(turn) for turn in said[:shared]] + fresh
                open_.add(conv_id.as_py(), said, fresh)
        if open_.conversations:
            yield open_.row(number)

    return by_path(conversations).mapInArrow(run, _SEQUENCES_SQL)


_READ = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
        ("learned", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def read_back(trained: DataFrame, tokenizer: str) -> DataFrame:
    """``conv_id``, ``turns``, ``learned`` (the text under the loss mask) and ``formatted_chars`` of each
    conversation in the sequences, from the tokens that its last one sees.

    Raises an error where positions do not count from 0 along a conversation.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = kept(f"turns by {tokenizer}", lambda: Template(tokenizer))
        for batch in batches:
            for row in range(batch.num_rows):
                token_ids, positions, mask = (
                    batch.column(name)[row].values.to_numpy(zero_copy_only=False)
                    for name in ("token_ids", "position_ids", "loss_mask")
                )
                turns = batch.column("turns")[row].as_py()
                rows = []
                for conversation in batch.column("conversations")[row].as_py():
                    last = turns[conversation["last_turn"]]
                    spans = [*last["sees"], last]
                    at = np.concatenate([np.arange(s["start"], s["end"]) for s in spans])
                    if not np.array_equal(positions[at], np.arange(len(at))):
                        raise ValueError(f"positions of conversation {conversation['conv_id']} have gaps")
                    formatted = template.decode(token_ids[at])
                    rows.append(
                        {
                            "conv_id": conversation["conv_id"],
                            "turns": [{"role": r, "text": t} for r, t in turns_of(formatted)],
                            "learned": unescape(template.decode(token_ids[at[mask[at]]])),
                            "formatted_chars": len(formatted),
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, schema=_READ)

    return trained.select("token_ids", "position_ids", "loss_mask", "turns", "conversations").mapInArrow(
        run,
        "conv_id bigint, turns array<struct<role: string, text: string>>, learned string, formatted_chars bigint",
    )


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


_PROBE = "</s>[INST] ok [/INST]"

_ESCAPES_SQL = " + ".join(
    f"(length(whole) - length(replace(whole, '{c}', ''))) // {len(c)}" for c in ("\\", *CONTROL_STRINGS)
)


@query(
    "op12_chat_prefix_tree",
    f"""
    WITH every AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '{_PROBE}'
        UNION ALL SELECT -1, 1, 'assistant', '{_PROBE}'),
    joined AS (SELECT *, role || chr(10) || text AS whole FROM every)
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(whole || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
            FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum({len(TURN_START) + len(TURN_END) + 1} + length(whole) + {_ESCAPES_SQL}
            + length(role) - length(replace(role, chr(10), ''))) AS BIGINT) AS formatted_chars
    FROM joined GROUP BY conv_id
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that says control strings, as read back from the sequences."""
    probe = spark.createDataFrame(
        pa.table({"conv_id": [-1, -1], "turn": [0, 1], "role": ["user", "assistant"], "text": [_PROBE] * 2})
    )
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = read_back(sequences(given.unionByName(probe), tokenizer_path()), tokenizer_path())
    said = F.transform("turns", lambda turn: F.concat(turn.role, F.lit("\n"), turn.text, F.lit("\n")))
    return found.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.char_length("learned").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("learned"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
