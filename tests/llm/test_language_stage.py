"""Short texts whose words fit several languages stay; only those without a letter go."""

import corpus_pipeline


def test_unsure_texts_stay(make):
    rows = [(i, "hotel radio taxi", lang) for i, lang in enumerate(("de", "en", "es", "fr"))]
    rows += [(4, "hotel", None), (5, "radio taxi", None), (6, "12 !", None), (7, None, None)]
    docs = make("doc_id long, text string, lang string", *rows)
    kept = corpus_pipeline.language_id(docs.sparkSession, docs, "")
    assert {r["doc_id"] for r in kept.collect()} == set(range(6))
