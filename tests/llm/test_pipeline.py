"""The pipeline against plain versions of its stages, each on its own input."""

from collections import Counter, defaultdict

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import adaptive_rules, toxicity
from millrace.llm.common import stage
from millrace.tables import load
from tests.llm.support import FOLDER, no_documents, odd_documents
from tests.llm.test_near import close_pairs, plain_counts, plain_fingerprint, plain_groups, roots
from tests.llm.test_tokens import check_packing, packed_ids


def plain_stages(spark, docs, folder):
    """What each stage should leave: doc_ids of its output, from the rows that it was given."""
    rows = yield
    scores = toxicity.toxicity(docs, load(spark, folder, "labels")).collect()
    rows = yield Counter(r.doc_id for r in scores if not r.predicted)
    good = adaptive_rules.quality_report(rows).collect()
    plain = Counter((r.doc_id, *plain_counts(r.text)[:3], plain_counts(r.text)[5]) for r in rows.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.base_failed) for r in good) == plain
    rows = yield Counter(r.doc_id for r in good if r.kept)
    rows = yield Counter(min(m)[4] for m in plain_groups([(r.doc_id, r.text) for r in rows.collect()]).values())
    prints = [(r.doc_id, plain_fingerprint(r.text)) for r in rows.collect()]
    classes, members = roots({p for _, p in prints}, close_pairs([p for _, p in prints])), defaultdict(list)
    for doc, p in prints:
        members[classes[p]].append(doc)
    yield Counter(min(m) for m in members.values())


def test_stages(spark):
    docs = load(spark, FOLDER, "documents")
    expected = plain_stages(spark, docs, FOLDER)
    next(expected)
    for name, work in corpus_pipeline.STAGES[:-1]:
        want = expected.send(docs)
        before, docs = docs, stage(work(spark, docs, FOLDER), name)
        assert docs.columns == before.columns and docs.dtypes == before.dtypes
        assert Counter(r.doc_id for r in docs.select("doc_id").collect()) == want, name
        assert docs.exceptAll(before).count() == 0
    assert 0 < docs.count() < 200
    word = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = Counter()
    for r in docs.collect():
        ids = word.encode(r.text, add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            pieces[r.doc_id, k // 4096, k, packed_ids(ids[k : k + 4096])] += 1
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.ids_crc32) for r in got) == pieces
    check_packing(got)


def test_awkward_rows(spark):
    for first in (odd_documents(spark), no_documents(spark)):
        docs = stage(first, "odd")
        for name, work in corpus_pipeline.STAGES[:-1]:
            after = stage(work(spark, docs, FOLDER), name)
            assert after.dtypes == docs.dtypes
            docs = after
        assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() >= docs.count()
