"""Packing, language identification, personal data, license scans and the language model."""

import hashlib
import math
import random
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__
from compare import differences, tables_of
from plumbline.llm import langid, licenses, ngrams, packing, passages, pii
from plumbline.llm.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
SPACED = rb"[^\x20\x09-\x0D]+"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    __spark_entry__.queries()
    assert differences(QUERIES[name](spark, SF_DIR), tables_of(SF_DIR), ORACLES[name]) is None


def pieces_of(rows):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    return by_doc, by_sequence


def test_packing_is_an_exact_round_trip(spark, documents, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    rows = packing.pack(documents, packing.tokenizer_path()).collect()
    by_doc, by_sequence = pieces_of(rows)
    assert by_doc.keys() == texts.keys()
    for doc_id, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.start)
        ids = tokenizer.encode(texts[doc_id], add_special_tokens=False).ids + [1]
        assert [i for r in pieces for i in r.ids] == ids
        for r in pieces:
            assert ids[r.start : r.start + r.length] == r.ids and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        fill = 0
        for r in pieces:
            assert r.offset == fill
            fill += r.length
        assert fill == 2048 or fill < 2048 and fill & (fill - 1) == 0


def test_packing_of_edges(spark, edges, nothing):
    rows = packing.pack(edges, packing.tokenizer_path(), keep_ids=False).collect()
    assert sum(r.length for r in rows if r.doc_id in (1, 2)) == 2
    assert Counter(r.doc_id for r in rows if r.start == 0)[7] == 2
    assert packing.pack(nothing, packing.tokenizer_path()).count() == 0


def test_tokens_of_cut_texts_are_those_of_whole_ones():
    encoder = packing.Encoder(packing.tokenizer_path())
    odd = ["", "a  b", " x", "x ", "a\n\nb  c\n", "<|endoftext|> hi <|endoftext|>x", "\x1c a   c", "\x00 a b"]
    rng = random.Random(3)
    odd += ["".join(rng.choice("ab \n.é'1\t ") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    for text in odd:
        whole = encoder._tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.encode_all([text])[0].tolist() == whole, repr(text)
    together = encoder.encode_all(odd * 2)
    fresh = packing.Encoder(packing.tokenizer_path())
    assert [ids.tolist() for ids in together] == [ids.tolist() for ids in fresh.encode_all(odd * 2)]
    assert encoder.encode_all([""])[0].tolist() == []


def test_pieces_that_are_forgotten_are_learned_again(texts, monkeypatch):
    whole = packing.Encoder(packing.tokenizer_path()).encode_all(list(texts.values()))
    monkeypatch.setattr(packing, "CACHED_PIECES", 100)
    monkeypatch.setattr(packing, "JOINED_PIECES", 7)
    encoder = packing.Encoder(packing.tokenizer_path())
    for text, ids in zip(texts.values(), whole, strict=True):
        assert encoder.encode_all([text])[0].tolist() == ids.tolist()


def test_every_document_goes_where_the_sum_of_squares_grows_least():
    """Against a plain loop over the levels, for thousands of documents."""
    capacity, rng = 64, random.Random(11)
    packer, counts = packing.Packer(capacity), Counter()
    for doc in range(5000):
        size = min(200, int(rng.paretovariate(0.8)))
        packer.add(doc, size)
        rest = size % capacity
        if not rest:
            continue
        costs = {}
        for level in range(capacity - rest + 1):
            if level and not counts[level]:
                continue
            after = Counter(counts)
            if level:
                after[level] -= 1
            if level + rest < capacity:
                after[level + rest] += 1
            costs[level] = sum(n * n for n in after.values()) - sum(n * n for n in counts.values())
        best = max(level for level, cost in costs.items() if cost == min(costs.values()))
        if best:
            counts[best] -= 1
        if best + rest < capacity:
            counts[best + rest] += 1
        if doc % 100 == 0:
            assert +counts == +Counter(dict(enumerate(packer._counts.tolist())))
    assert +counts == +Counter(dict(enumerate(packer._counts.tolist())))


def test_sum_of_squares_prefers_the_level_that_grows_least():
    packer = packing.Packer(8)
    packer.add(0, 3)
    packer.add(1, 5)  # closes the window of 3
    assert packer.full == [[(0, 0, 3), (1, 0, 5)]]
    packer.add(2, 19)  # two full windows and a rest of 3
    assert len(packer.full) == 3
    assert sorted(sum(p[2] for p in w) for w in packer.close()) == [1, 2, 8, 8, 8]


def test_language_of_held_out_documents(spark, documents):
    rows = langid.op9(spark, SF_DIR).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 20 and sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_gradients_are_those_of_the_loss():
    rng = np.random.RandomState(0)
    network = langid.Network(["a", "b", "c"], hidden=4)
    network.weights = {k: v.astype("f8") for k, v in network.weights.items()}
    codes = rng.randint(0, 256, (5, 6)).astype(np.int16)
    codes[3:, 0] = codes[2:, 3] = 256
    labels, there = rng.randint(0, 3, 6), codes < 256

    def loss():
        p = network.positions(codes)[:, np.arange(6), labels]
        return -(np.log(p) * there).sum() / there.sum()

    for name, gradient in network.gradients(codes, labels).items():
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        kept, step = network.weights[name][at], 1e-3
        values = []
        for way in (step, -step):
            network.weights[name][at] = kept + way
            values.append(loss())
        network.weights[name][at] = kept
        assert gradient[at] == pytest.approx((values[0] - values[1]) / (2 * step), rel=0.02)


def test_language_of_edges(spark, edges, nothing):
    network = langid.train(edges, steps=30)
    rows = {r.doc_id: r for r in langid.identify(edges, network).collect()}
    assert {k for k, r in rows.items() if r.lang_pred == "und"} == {1, 2, 3, 9}
    assert langid.train(nothing) is None
    assert {r.lang_pred for r in langid.identify(edges, None).collect()} == {"und"}
    assert langid.identify(nothing, network).count() == 0
    kept = langid.recognized(edges, min_score=0.0)
    assert kept.columns == edges.columns and kept.filter("doc_id in (1, 2, 3, 9)").isEmpty()


def plain_patterns(text):
    forms = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def fits(kind, found):
        digits = [int(c) for c in found if c in "0123456789"]
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "phone":
            return 9 <= len(digits) <= 15
        if kind == "card":
            doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])]
            return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
        return True

    return {
        kind: [m.span() for m in re.finditer(form, text) if fits(kind, m[0])]
        for kind, form in forms.items()
    }


def test_patterns_find_what_plain_expressions_find():
    rng = random.Random(1)
    for alphabet in ("a.@-b1", "12.3", "0123456789 -", "+1 ().-2345678901", "a@b.c+1 .-25"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
            assert pii.patterns(text) == plain_patterns(text), text


def test_personal_data_of_all_documents(spark, texts):
    for r in pii.op7(spark, SF_DIR).collect():
        spans = plain_patterns(texts[r.doc_id])
        base = ",".join(f"{kind}:{a}:{b}" for kind in pii.KINDS for a, b in spans[kind])
        assert hashlib.sha256(base.encode()).hexdigest() == r.base_sha256
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(spans[k]) for k in pii.KINDS]


def test_repetitions_are_carried_to_distant_tokens(spark, documents, edges, nothing):
    field = pii.train(documents)
    text = "Call +1 (456) 555-2186 now. " + "words " * 50 + "Again: 456-555-2186. Room 4711, 2019-2020."
    found = [pii.patterns(text)]
    [(kind, start, end)] = pii.added(pii.Graph([text], found), field, found)[0]
    assert (kind, text[start:end]) == ("phone", "456-555-2186")
    assert pii.personal_data(edges, field).filter("size(found) > 0").isEmpty()
    assert pii.personal_data(nothing, pii.train(nothing)).count() == 0


def test_license_blocks(spark, edges, nothing):
    lines = [
        (1, "Code: licensed under the APACHE license, version 2.0\nother line"),
        (2, "released under the\nmit license"),
        (3, "ALL RIGHTS\nreserved, cc by cc-by"),
        (4, "lıcensed under the lİcense Kernel"),
    ]
    rows = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(lines, "doc_id bigint, text string")).collect()}
    assert (rows[1].labels, rows[1].score, rows[1].base_labels) == ("apache-2.0", 1.0, "")
    assert rows[2].labels == ""  # two blocks
    assert (rows[3].base_labels, rows[3].n_base, rows[3].first_word, rows[3].last_word) == ("cc-by,reserved", 3, 0, 5)
    assert (rows[4].n_words, rows[4].labels) == (5, "")
    assert licenses.scan(edges).count() == 13 and licenses.scan(nothing).count() == 0


def brute_model(train):
    counts = Counter(w for words in train for w in words)
    pairs = Counter(p for words in train for p in zip([b"\t", *words], words))
    before = Counter(b for _, b in pairs)
    d2, d1 = (
        [0, *ngrams._discounts([sum(v == k for v in c.values()) for k in (1, 2, 3, 4)])]
        for c in (pairs, before)
    )
    after, mass = Counter(), defaultdict(float)
    for (a, _), n in pairs.items():
        after[a] += n
        mass[a] += d2[min(n, 3)]
    rest = sum(d1[min(n, 3)] for n in before.values()) / len(pairs)

    def p(a, b):
        lower = (before[b] - d1[min(before[b], 3)]) / len(pairs) + rest / (len(counts) + 1)
        if not after[a]:
            return lower
        return (pairs[a, b] - d2[min(pairs[a, b], 3)]) / after[a] + mass[a] / after[a] * lower

    return counts, p


def test_language_model_against_brute_force(spark, texts):
    words = {k: re.findall(SPACED, t.encode().lower()) + [b"\n"] for k, t in texts.items()}
    train = [w for k, w in words.items() if zlib.crc32(str(k).encode()) % 5 != 1]
    counts, p = brute_model(train)
    n, v = sum(counts.values()), len(counts)
    assert sum(p(b"the", w) for w in counts) + p(b"the", b"?\0") == pytest.approx(1)
    for r in ngrams.op1(spark, SF_DIR).collect():
        own = words[r.doc_id]
        assert (r.n_tokens, r.train_tokens) == (len(own), n)
        assert r.n_known == sum(counts[w] > 0 for w in own)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        full = sum(math.log10(p(a, b)) for a, b in zip([b"\t", *own], own))
        assert (r.base_score, r.score) == (pytest.approx(base), pytest.approx(full))


def test_language_model_of_edges(spark, edges, nothing):
    rows = ngrams.score(edges, ngrams.train(edges)).collect()
    assert len(rows) == 13 and all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    empty = ngrams.train(nothing)
    assert {r.score for r in ngrams.score(edges, empty).collect()} == {0.0}
    assert ngrams.score(nothing, empty).count() == 0


def test_seeds_do_not_depend_on_other_texts():
    rng = np.random.RandomState(0)
    texts = [" ".join(rng.choice(list("abcdefg"), rng.randint(0, 60))).encode() for _ in range(40)]
    doc, place, value = passages.seeds(texts)
    for i, text in enumerate(texts):
        _, own_place, own_value = passages.seeds([text])
        assert (place[doc == i] == own_place).all() and (value[doc == i] == own_value).all()
        runs = max(0, len(text.split()) - passages.SEED_WORDS + 1)
        for first in range(runs - passages.NEIGHBOURS + 1):
            assert any(first <= p < first + passages.NEIGHBOURS for p in own_place)


def test_chains_and_alignments_against_brute_force():
    rng = np.random.RandomState(1)

    def best(x, y):
        score = {}
        for j in np.lexsort((-y, x)):
            before = [score[i] - passages.GAP_COST * (x[j] - x[i] + y[j] - y[i]) for i in score if x[i] < x[j] and y[i] < y[j]]
            score[j] = passages.SEED_WORDS + max([0, *before])
        return max(score.values())

    for _ in range(100):
        n = rng.randint(2, 30)
        x, y = rng.randint(0, 60, n), rng.randint(0, 60, n)
        for chain in passages.best_chains(x, y)[:1]:
            a, b = x[chain], y[chain]
            assert (np.diff(a) > 0).all() and (np.diff(b) > 0).all()
            if len(chain) < n:
                cost = passages.GAP_COST * (a[-1] - a[0] + b[-1] - b[0])
                assert passages.SEED_WORDS * len(chain) - cost == pytest.approx(best(x, y))

    def common(a, b):
        row = [0] * (len(b) + 1)
        for w in a:
            last = row
            row = [0]
            for k, v in enumerate(b):
                row.append(last[k] + 1 if w == v else max(row[-1], last[k + 1]))
        return row[-1]

    for _ in range(100):
        a, b = (rng.randint(0, 5, rng.randint(0, 30)).tolist() for _ in range(2))
        assert passages.common_words(a, b) == common(a, b)


def test_spans_are_aligned_at_once_as_one_by_one(monkeypatch):
    monkeypatch.setattr(passages, "MIN_WORDS", 12)
    monkeypatch.setattr(passages, "REACH", 5)
    share, common = passages.MIN_IDENTITY, passages.common_words

    def plain(x, y, a, b, c, d):
        while a > 0 and c > 0 and x[a - 1] == y[c - 1]:
            a, c = a - 1, c - 1
        while b < len(x) and d < len(y) and x[b] == y[d]:
            b, d = b + 1, d + 1
        same, short = common(x[a:b], y[c:d]), min(b - a, d - c) < 12
        reach = 12 if short else 5

        def ways(own, other):
            for i in range(len(own) + 1):
                found = [common(own[:i], other[:j]) for j in range(len(other) + 1)]
                j = max(range(len(found)), key=lambda j: (found[j] - share * max(i, j), j))
                yield i, j, found[j], found[-1]

        left = [*ways(x[max(a - reach, 0) : a][::-1], y[max(c - reach, 0) : c][::-1])]
        right = [*ways(x[b : b + reach], y[d : d + reach])]
        pairs = [(v, w, b - a + v[0] + w[0], d - c + v[1] + w[1]) for v in left for w in right]
        if short and not any(m >= 12 and same + v[3] + w[3] >= share * m for v, w, m, _ in pairs):
            return a, b, c, d, same
        v, w = (max(side, key=lambda e: e[2] - share * max(e[:2])) for side in (left, right))
        if min(b - a + v[0] + w[0], d - c + v[1] + w[1]) < 12:
            shares = [(same + v[2] + w[2]) / max(m, n) if min(m, n) >= 12 else 0 for v, w, m, n in pairs]
            if max(shares) >= share:
                v, w = pairs[shares.index(max(shares))][:2]
        a, b, c, d = a - v[0], b + w[0], c - v[1], d + w[1]
        return a, b, c, d, common(x[a:b], y[c:d])

    rng = np.random.RandomState(2)
    words, sides, spans, expected = [], [], [], []
    for _ in range(600):
        x = rng.randint(0, rng.choice([3, 30, 1000]), rng.randint(4, 45)).tolist()
        y = [rng.randint(0, 30) if rng.rand() < rng.choice([0.05, 0.2]) else word for word in x]
        y[len(y) // 2 : len(y) // 2] = rng.randint(0, 30, rng.randint(0, 3)).tolist()
        a = rng.randint(0, len(x) - 3)
        b = rng.randint(a + 2, min(a + 20, len(x)) + 1)
        at, other = len(words), len(words) + len(x)
        words += x + y
        sides.append([at, other, len(words)])
        spans.append([at + a, at + b, other + a, other + b])
        a, b, c, d, same = plain(x, y, a, b, a, b)
        expected.append([at + a, at + b, other + c, other + d, same])
    calls, ends, sides = [], passages.ends, np.array(sides)
    monkeypatch.setattr(passages, "ends", lambda x, y: calls.append(len(x)) or ends(x, y))
    found = passages.align(np.array(words, "<u2"), sides[:, :2], sides[:, 1:], np.array(spans))
    assert found.tolist() == expected
    assert len({row[1] - row[0] >= 12 for row in expected}) == 2 and len(calls) <= 10


def test_every_shared_run_of_fifty_words_is_found(spark, documents, texts, edges, nothing):
    rows = passages.op3(spark, SF_DIR).collect()
    words = {k: re.findall(rb"[0-9a-z\x80-\xff]+", t.encode().lower()) for k, t in texts.items()}
    runs = defaultdict(set)
    for k, w in words.items():
        for i in range(len(w) - passages.MIN_WORDS + 1):
            runs[tuple(w[i : i + passages.MIN_WORDS])].add(k)
    sharing = set().union(*[k for k in runs.values() if len(k) > 1])
    assert sharing <= {r.doc_id for r in rows} | {r.other_id for r in rows}
    for r in rows:
        assert min(r.end - r.start, r.other_end - r.other_start) >= passages.MIN_WORDS
        assert r.end <= len(words[r.doc_id]) and r.other_end <= len(words[r.other_id])
        same = passages.common_words(words[r.doc_id][r.start : r.end], words[r.other_id][r.other_start : r.other_end])
        assert r.identity == pytest.approx(same / max(r.end - r.start, r.other_end - r.other_start))
    assert passages.shared_passages(edges).isEmpty() and passages.shared_passages(nothing).isEmpty()


def made_up(n, start):
    return [f"w{k}" for k in range(start, start + n)]


def test_parts_of_a_passage_held_by_others_do_not_hide_its_link(spark):
    """Links of each two documents with fifty words in a row in common, by way of others or not."""
    rows, fresh = [], 0
    for case in range(12):
        shared = made_up(60, 10_000 * case)
        for k, part in enumerate((shared, shared, shared[:30], shared[30:], shared[15:45])):
            own = [made_up(25, 1_000_000 + fresh + 25 * side) for side in (0, 1)]
            rows.append((10 * case + k, " ".join([*own[0], *part, *own[1]])))
            fresh += 50
    found = passages.shared_passages(spark.createDataFrame(rows, "doc_id bigint, text string"))
    links = {frozenset((r.doc_id, r.other_id)) for r in found.collect()}
    assert links == {frozenset((10 * case, 10 * case + 1)) for case in range(12)}


def test_edits_near_the_ends_of_short_passages(spark):
    """Passages of 50 to 80 words, each with every ninth word or one near each end changed."""
    rows, wanted = [], set()
    for case, n in enumerate(range(50, 81, 2)):
        for kind, edits in enumerate(([6, n - 6], [2, n - 3], list(range(4, n, 9)))):
            number = 10 * case + 2 * kind
            passage = made_up(n, 1000 * number)
            edited = [f"edit{number}x{k}" if k in edits else w for k, w in enumerate(passage)]
            for doc_id, part in ((number, passage), (number + 1, edited)):
                own = [made_up(25, 10**6 + 100 * doc_id + 50 * side) for side in (0, 1)]
                rows.append((doc_id, " ".join([*own[0], *part, *own[1]])))
            # Where an edit lies in each run of nine words, no seed may be left in common.
            whole = passages.seeds([rows[-2][1].encode()])[2], passages.seeds([rows[-1][1].encode()])[2]
            if len(np.intersect1d(*whole)):
                wanted.add(frozenset((number, number + 1)))
    found = passages.shared_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(wanted) > 40
    assert {frozenset((r.doc_id, r.other_id)) for r in found} == wanted
    assert len({(r.doc_id, r.start, r.other_id, r.other_start) for r in found}) == len(found)


def test_only_spans_that_may_become_passages_are_aligned(monkeypatch):
    """One seed in common among other words costs no alignment, and equal spans cost one."""
    rng, words, sides, spans = np.random.RandomState(3), [], [], []
    for k in range(300):
        x, y = (rng.randint(0, 60_000, 120).tolist() for _ in range(2))
        y[50:55] = x[50:55]
        if k == 0:
            y[50:90] = x[50:90]
            y[96:120] = x[96:120]
        at = len(words)
        words += x + y
        for first in (50, 60, 70) if k == 0 else (50,):
            sides.append([at, at + 120, at + 240])
            spans.append([at + first, at + first + 5, at + 120 + first, at + 125 + first])
    aligned, ends, sides = [], passages.ends, np.array(sides)
    monkeypatch.setattr(passages, "ends", lambda x, y: aligned.append(len(x)) or ends(x, y))
    found = passages.align(np.array(words, "<u2"), sides[:, :2], sides[:, 1:], np.array(spans))
    assert sum(aligned) == 2
    assert found[:3].tolist() == [[50, 120, 170, 240, 64]] * 3
    assert (found[3:, 1] - found[3:, 0] < 10).all()


def test_windows_of_one_anchor_find_their_first_holder():
    """Against a plain loop over the windows of random texts, with batches of a few rows."""
    rng = np.random.RandomState(4)
    pool = [rng.randint(0, 9, 70).tolist() for _ in range(4)]
    texts = [sum((pool[k] for k in rng.randint(0, 4, 3)), []) for _ in range(12)]
    rows, holders = [], defaultdict(list)
    for doc, text in enumerate(texts):
        for k in range(0, len(text), passages.BLOCK):
            rows.append((doc, 0, k // passages.BLOCK, np.array(text[k : k + passages.BLOCK], "<u2").tobytes()))
        rows += [(doc, 1, k, None) for k in range(0, len(text) - 5, 7)]
        for k in range(len(text) - passages.MIN_WORDS + 1):
            holders[tuple(text[k : k + passages.MIN_WORDS])].append((doc, k))

    def batches(rows, kinds, names):
        arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        whole = pa.RecordBatch.from_arrays(arrays, names=names)
        return [whole[k : k + 5] for k in range(0, whole.num_rows, 5)]

    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
    stretches = [
        row.values()
        for batch in passages._document_windows(batches(rows, kinds, ["doc", "kind", "at", "words"]))
        for row in batch.to_pylist()
    ]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
    stretches = sorted(map(tuple, stretches), key=lambda row: row[:3])
    found = set()
    for batch in passages._held_windows(batches(stretches, kinds, ["anchor", "doc", "place", "hashes"])):
        for row in batch.to_pylist():
            found |= {(row["doc"], row["place"] + k, row["other"], row["other_place"] + k) for k in range(row["n"])}
    assert found == {(*own, *held[0]) for held in holders.values() for own in held if own[0] != held[0][0]}


def test_tables_that_nothing_reads_any_more_are_deleted(spark, monkeypatch):
    rows = [(k, " ".join([*made_up(20, 1000 * k), *made_up(60, 9_000_000)])) for k in range(4)]
    stored = {}
    written = passages.materialize
    monkeypatch.setattr(passages, "materialize", lambda df, name: stored.setdefault(name, written(df, name)))
    found = passages.shared_passages(spark.createDataFrame(rows, "doc_id bigint, text string"))
    left = {name for name, df in stored.items() if os.path.exists(df.inputFiles()[0].removeprefix("file://"))}
    assert left == {"blocks", "chains"} and len(stored) > 4 and found.count() == 3
