"""The pipeline: stages in order, each on all that its predecessor kept, against plain versions."""

from collections import Counter, defaultdict

import corpus_pipeline
from basketlens.llm import pii
from basketlens.llm.queries import TOKENIZER
from basketlens.llm.tokens import Encoder
from basketlens.session import staged
from test_divergence import plain_kept
from test_mixing import plain_times
from test_simhash import plain_components, plain_fingerprint

STAGES = ["quality rules", "near duplicates", "personal data", "mixing", "packing"]


def test_stages(spark, documents, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == STAGES
    given, tables = documents, []
    for _, stage in corpus_pipeline.STAGES:
        given = staged(stage(spark, given, folder), "stage")
        tables.append(given)
    rows = [t.collect() for t in tables]
    assert all(t.columns == documents.columns for t in tables[:4])
    source = {r.doc_id: r for r in documents.collect()}
    kept = plain_kept([(i, r.text, r.lang) for i, r in source.items()])
    assert sorted(rows[0]) == sorted(source[i] for i in kept)
    components = plain_components([(i, plain_fingerprint(source[i].text)) for i in kept])
    assert sorted(rows[1]) == sorted(source[i] for i in set(components))
    clean = {i: pii.redact(source[i].text) for i in set(components)}
    assert {r.doc_id: r.text for r in rows[2]} == clean and len(rows[2]) == len(clean)
    assert all(r.n_chars == len(r.text) for r in rows[2] if r.text != source[r.doc_id].text)
    times = plain_times([(r.doc_id, r.text, r.source) for r in rows[2]])
    assert Counter(rows[3]) == Counter({r: times[r.doc_id] for r in rows[2] if times[r.doc_id]})
    encoder = Encoder(TOKENIZER)
    sizes = Counter((r.doc_id, len(encoder.tokenizer.encode(r.text, add_special_tokens=False).ids) + 1) for r in rows[3])
    pieces = defaultdict(int)
    for r in rows[4]:
        pieces[r.doc_id, r.doc_tokens] += r.length
    assert pieces == {(i, n): n * k for (i, n), k in sizes.items()}


def test_an_empty_table(spark, documents, folder):
    given = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        given = staged(stage(spark, given, folder), "stage")
        assert given.count() == 0
