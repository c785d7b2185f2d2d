"""Cross-tokenizer alignment against whole texts encoded by the libraries and plain loops over byte ranges."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import pytest

from flowledger.llm import bpe, cross_tokenizer as cross
from flowledger.llm.queries import QUERIES
from tests.llm.conftest import ROWS


@pytest.fixture(scope="session")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(bpe.vocabulary_file(cross.BYTE_FILE))
    a.encode_special_tokens = True
    byte_of = {c: b for b, c in enumerate(bpe._byte_characters())}
    a_bytes = {i: bytes(byte_of[c] for c in token) for token, i in a.get_vocab(False).items()}
    b = sentencepiece.SentencePieceProcessor(model_file=bpe.vocabulary_file(cross.PIECE_FILE))
    b_bytes = {}
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        b_bytes[i] = bytes([int(piece[1:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()
    return a, a_bytes, b, b_bytes


def plain(text, libraries):
    """Groups of ids and the linked pairs of one text."""
    a, a_bytes, b, b_bytes = libraries
    if not text:
        return [], []
    sides = [(a.encode(" " + text, add_special_tokens=False).ids, a_bytes), (b.encode(text), b_bytes)]
    if any(b"".join(table[i] for i in ids) != b" " + text.encode() for ids, table in sides):
        return [], []
    spans = []
    for ids, table in sides:
        start, found = 0, []
        for i in ids:
            found.append((start, start + len(table[i]), i))
            start += len(table[i])
        spans.append(found)
    cuts = sorted({end for _, end, _ in spans[0]} & {end for _, end, _ in spans[1]})
    groups, before, ends = [], 0, [[end for _, end, _ in side] for side in spans]
    for cut in cuts:
        groups.append(tuple([i for _, _, i in side[bisect_right(e, before) : bisect_right(e, cut)]] for side, e in zip(spans, ends)))
        before = cut
    links = [(x, y) for s, e, x in spans[0] for t, f, y in spans[1] if s < f and t < e] if len(text) < 3000 else None
    if links is None:
        links, j = [], 0
        for s, e, x in spans[0]:
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                links.append((x, spans[1][k][2]))
                k += 1
    return groups, links


def written(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def expected(rows, libraries):
    found = [(i, *plain(text, libraries)) for i, text in rows]
    counts = Counter(pair for _, _, links in found for pair in links)
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    for i, groups, links in found:
        sizes = (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links))
        sums = (sum(counts[x, y] == best[y] for x, y in links), sum(counts[pair] for pair in links))
        yield (i, *sizes, *sums, hashlib.sha256(written(groups).encode()).hexdigest() if groups else "")


def rows_of(frame):
    names = ("doc_id", *cross.SIZES, "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(row[n] for n in names) for row in frame.collect()), key=repr)


ODD = [
    "<|endoftext|> and <s> </s> <unk> <0x41>", "a ▁ b", "good words ▁ and more", "héllo 日本 \U0001f642 ꙮ \U00010348\U00010348 नि", "  two  blanks  ", "tab\t tab\n \nend ", " ", "\n", "\x00 \x01\x7f",
    "é ẛ̣ ﬁ   　x   y", "don't we'll  I'M 'tis", "x" * 5000, "日" * 700, "1234567890 12 345", "a​b ﻿c", "\r\n\r\n", "word ́mark", "a  b", "...  !!", "\U0001f468‍\U0001f469‍\U0001f467 ok",
]


def test_op11_whole_table(spark, sf_dir, texts, libraries):
    assert rows_of(QUERIES["op11_cross_tokenizer"](spark, sf_dir)) == sorted(expected(texts.items(), libraries), key=repr)


@pytest.mark.parametrize("most", [cross.PAIRS_SENT, 150])
def test_odd_texts(spark, odd_docs, libraries, most):
    """With few pairs sent at a time, the sums come from many rounds."""
    rows = [(row[0], row[1]) for row in ROWS if row[1] is None or len(row[1]) < 10_000] + [(100 + i, text) for i, text in enumerate(ODD)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(cross.alignment_report(frame, most=most)) == sorted(expected(rows, libraries), key=repr)


def test_op11_odd_rows(odd_docs, no_docs, libraries):
    assert rows_of(cross.alignment_report(odd_docs)) == sorted(expected([row[:2] for row in ROWS], libraries), key=repr)
    assert cross.alignment_report(no_docs).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_words_are_encoded_alike_alone(libraries, seed):
    rng = np.random.default_rng(seed)
    letters = list("ab eE.,'19  \n\té日\U0001f642 ́_-") + [" the", " of", "'s", "ing "]
    texts = ["".join(rng.choice(letters, rng.integers(1, 60))) for _ in range(400)]
    words = cross.aligner(*cross._files(None))
    numbers, counts = words.numbers(texts)
    kept = cross._whole(words.known, numbers, counts)
    assert list(cross._texts_of_groups(words.known, numbers, counts, kept)) == [written(plain(text, libraries)[0]) for text in texts]
    words.forget()


def test_forgotten_words_are_learned_again(spark, sf_dir, texts, libraries, monkeypatch):
    documents = [(i, text) for i, text in texts.items()][:60]
    one, another = cross.Aligner(*cross._files(None)), cross.aligner(*cross._files(None))
    another.forget()
    monkeypatch.setattr(cross, "KEPT_WORDS", 50)
    for _, text in documents:
        if another.full():
            another.forget()
        if text:
            both = [list(cross._texts_of_groups(w.known, *found, cross._whole(w.known, *found))) for w in (one, another) for found in [w.numbers([text])]]
            assert both[0] == both[1]
    assert not one.full() or len(one.known.groups) > 50


def test_groups_as_arrays(odd_docs, libraries):
    found = cross.align_documents(odd_docs.withColumnRenamed("fp", "groups")).collect()
    for row in found:
        assert [(g.a, g.b) for g in row["groups_"]] == [tuple(g) for g in plain(row.text, libraries)[0]]


def test_very_long_texts(libraries):
    rng = np.random.default_rng(1)
    word = "".join(rng.choice(list("abcdefgh"), 200_000))
    text = word + " " + "日本" * 30_000 + " tail"
    words = cross.Aligner(*cross._files(None))
    found = words.numbers([text])
    assert next(cross._texts_of_groups(words.known, *found, cross._whole(words.known, *found))) == written_fast(text, libraries)


def written_fast(text, libraries):
    a, a_bytes, b, b_bytes = libraries
    groups, left, right, i, j = [], [], [], 0, 0
    x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    at, bt = 0, 0
    while i < len(x) or j < len(y):
        if at <= bt:
            at, i = at + len(a_bytes[x[i]]), i + 1
            left.append(x[i - 1])
        else:
            bt, j = bt + len(b_bytes[y[j]]), j + 1
            right.append(y[j - 1])
        if at == bt and left and right:
            groups.append((left, right))
            left, right = [], []
    return written(groups)
