"""Alignment of two tokenizers against whole texts and plain loops."""

import base64
import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import alignment

ODD = [
    "é😀漢字龘 naïve  ﬁ①\t\tx",
    "</s>[INST] <|endoftext|> <0x0A><s> <unk>",
    "\n\nleading", "trailing \n ", " ", "  two  blanks ", "a\x00b \x1f c", "it's we'll 12 345,6",
    "a▁b", "▁", "words ▁ more", " nbsp em　wide", "é ​zero﻿", "𝔘𝔫𝔦 𐍈\n𐍈 𐍈",
    "\r\nwindows\r\n lines\r", "x" * 3000, "a \n b", "あいう えお\nか", "🏳️‍🌈 👨‍👩‍👧 👍🏽👍🏽", "_▂_", "\x85next", "'", "\n",
]


@pytest.fixture(scope="module")
def plain():
    """Tokens of a whole text by both tokenizers, with their bytes."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    first, second = alignment.tokenizer_paths()
    a = Tokenizer.from_file(first)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=second)
    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb")
    a_bytes = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}

    def b_bytes(n):
        piece = b.id_to_piece(n)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(n) else piece.replace("▁", " ").encode()

    def tokens(text):
        whole = f" {text}".encode()
        x = [(n, a_bytes[n]) for n in a.encode(f" {text}", add_special_tokens=False).ids]
        y = [(n, b_bytes(n)) for n in b.encode(text)]
        same = text and all(b"".join(t for _, t in side) == whole for side in (x, y))
        return (x, y) if same else ([], [])

    return tokens


def plain_rows(texts, tokens):
    def spans(side):
        found, at = [], 0
        for number, token in side:
            found.append((number, at, at + len(token)))
            at += len(token)
        return found

    made, documents = [], Counter()
    for text in texts:
        a, b = (spans(side) for side in tokens(text or ""))
        links, j = [], 0
        for n, start, end in a:
            while b[j][2] <= start:
                j += 1
            k = j
            while k < len(b) and b[k][1] < end:
                links.append((n, b[k][0]))
                k += 1
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        sides = []
        for side in (a, b):
            ids = defaultdict(list)
            for n, _, end in side:
                ids[int(np.searchsorted(cuts, end))].append(str(n))
            sides.append(ids)
        groups = ";".join(",".join(sides[0][k]) + "|" + ",".join(sides[1][k]) for k in range(len(cuts)))
        documents.update(set(links))
        made.append((len(a), len(b), len(cuts), links, groups))
    highest = Counter()
    for (n, _), count in documents.items():
        highest[n] = max(highest[n], count)
    return [
        (
            n_a, n_b, n_cuts, len(links),
            sum(documents[link] == highest[link[0]] for link in links),
            sum(documents[link] for link in links),
            hashlib.sha256(groups.encode()).hexdigest() if links else "",
        )
        for n_a, n_b, n_cuts, links, groups in made
    ]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_against_plain_loops(spark, texts, plain, as_table):
    every = [*list(texts.items())[:120], *enumerate(ODD, 10_000), *enumerate(ODD[:7], 20_000), (30_000, None)]
    rows = spark.createDataFrame(every, "doc_id bigint, text string").repartition(5)
    found = alignment.op11(spark, as_table(rows))
    assert found.columns == ["doc_id", *COLUMNS[:4], "groups_sha256", "n_best", "count_sum"]
    shown = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in found.collect()}
    wanted = plain_rows([text for _, text in every], plain)
    for (doc_id, text), row in zip(every, wanted, strict=True):
        assert shown[doc_id] == row, text
    assert sum(r[0] == 0 for r in wanted) == 3 + 1  # U+2581 and null


def test_pieces_are_as_whole_texts(plain):
    """Texts strung together from odd characters, which pieces cut everywhere."""
    aligner = alignment.Aligner(*alignment.tokenizer_paths())
    rng = np.random.RandomState(1)
    parts = [" ", "\n", "\t", " ", "a", "b'", "s", "é", "漢", "😀", "1", ",", "龘", "the", "\x1c", "​"]
    for _ in range(1500):
        text = "".join(rng.choice(parts, rng.randint(1, 12)))
        pieces = aligner.pieces(text)
        assert "".join(pieces) == f" {text}"
        aligner.learn(dict.fromkeys(pieces))
        numbers = [aligner.number[p] for p in pieces]
        groups = b";".join(aligner.groups[n] for n in numbers).decode().split(";")
        a, b = plain(text)
        assert [int(n) for g in groups for n in g.split("|")[0].split(",")] == [n for n, _ in a], text
        assert [int(n) for g in groups for n in g.split("|")[1].split(",")] == [n for n, _ in b], text


def test_caches_that_are_emptied(texts, monkeypatch):
    some = [t.encode() for t in list(texts.values())[:30]]
    paths = alignment.tokenizer_paths()
    whole = alignment._chunk(alignment.Aligner(*paths), some, True)
    monkeypatch.setattr(alignment, "CACHED_PIECES", 50)
    monkeypatch.setattr(alignment, "JOINED_PIECES", 3)
    small = alignment.Aligner(*paths)
    alignment._chunk(small, some[:7], False)
    again = alignment._chunk(small, some, True)
    for name, values in whole.items():
        assert np.array_equal(values, again[name]), name


def test_edges(edges, nothing):
    found = alignment.align(edges, *alignment.tokenizer_paths(), with_groups=True)
    rows = found.collect()
    assert len(rows) == 13 and sum(r.n_a == 0 for r in rows) == 2
    assert {(r.groups, r.groups_sha256, r.count_sum) for r in rows if r.doc_id in (1, 2)} == {("", "", 0)}
    twice = [r for r in rows if r.doc_id == 7]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert alignment.align(nothing, *alignment.tokenizer_paths()).count() == 0


def test_no_row_holds_more_than_a_document_or_a_pair(spark, documents):
    """Writers and readers of files hold many rows at once, so these may not be chunks."""
    rows = alignment.aligned_chunks(documents, *alignment.tokenizer_paths(), False)
    fields = [f for f in rows.schema.fields if f.dataType.typeName() in ("array", "binary")]
    sizes = [F.coalesce(F.octet_length(f.name) if f.dataType.typeName() == "binary" else F.size(f.name), F.lit(0)) for f in fields]
    most = documents.agg(F.max(F.octet_length("text"))).first()[0]
    found = rows.select((sum(sizes)).alias("size")).agg(F.max("size"), F.count(F.lit(1))).first()
    assert found[0] <= 2 * 4 * 2 * most
    assert found[1] > documents.count()
