"""Stages of the corpus pipeline against plain code."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from flowledger.llm import secrets
from tests.llm import brute


def test_stages_are_the_named_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "secrets", "mix", "bpe"]


def test_pipeline_against_plain_code(spark, sf_dir, documents):
    from tokenizers import Tokenizer

    from flowledger.llm.bpe import vocabulary_file

    docs = sorted((r.doc_id, r.text, r.source) for r in documents.collect())
    docs = [d for d in docs if any(c.isalpha() for c in d[1])]
    root = brute.components([brute.simhash(text) for _, text, _ in docs])
    docs = [d for k, d in enumerate(docs) if root[k] == k]
    docs = [(d, secrets._masked(t, secrets.find_secrets([t], secrets.RULES)[0], "[secret]"), s) for d, t, s in docs]
    assert not any(brute.base_secrets(t) for _, t, _ in docs)
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    reference = Tokenizer.from_file(vocabulary_file())
    ids = {d: reference.encode(t, add_special_tokens=False).ids for d, t, _ in docs}
    assert all(r.ids == ids[r.doc_id] and r.n_tokens == len(r.ids) for r in rows)
    copies, sizes = Counter(r.doc_id for r in rows), {d: len(brute.words(t)) for d, t, _ in docs}
    totals = Counter()
    for d, _, s in docs:
        totals[s] += sizes[d]
    for s, goal in brute.targets(dict(totals)).items():
        own = [d for d, _, source in docs if source == s]
        assert all(copies[d] <= 2 for d in own)
        assert abs(sum(copies[d] * sizes[d] for d in own) - goal) <= max(sizes[d] for d in own) / 2 + 1e-6


def test_stages_take_odd_rows(spark, odd_docs, no_docs, sf_dir):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, sf_dir)
            assert after.columns == docs.columns, name
            assert after.count() <= 2 * docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()


def test_language_stage_keeps_what_has_letters(spark, odd_docs, sf_dir):
    kept = corpus_pipeline.identify_language(spark, odd_docs, sf_dir).collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 1, 5, 6, 6, 7, 9] and all(r.lang for r in kept)


def test_language_stage_keeps_letters_where_no_language_is_named(spark, odd_docs, sf_dir):
    nameless = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.identify_language(spark, nameless, sf_dir)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    assert sorted(r.doc_id or 0 for r in rows) == [0, 1, 5, 6, 6, 7, 9] and {r.lang for r in rows} == {None}
    undetermined = odd_docs.withColumn("lang", F.lit("und"))
    assert sorted(r.doc_id or 0 for r in corpus_pipeline.identify_language(spark, undetermined, sf_dir).collect()) == [0, 1, 5, 6, 6, 7, 9]


def test_secret_stage_masks(spark, odd_docs, sf_dir):
    rows = {r.doc_id: r for r in corpus_pipeline.remove_secrets(spark, odd_docs, sf_dir).collect()}
    assert rows[1].text == "The [secret] and the rest of a text" and rows[1].n_chars == len(rows[1].text) and rows[2].text is None
