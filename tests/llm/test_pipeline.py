"""The pipeline's rows against its stages done one document at a time."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from orderloom.llm import pii, quality
from tests.conftest import SF_DIR
from tests.llm.test_similarity import brute_components, shingles


def test_pipeline_equals_its_stages_by_brute_force(spark, duck):
    docs = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    tables = {name: spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels")}

    model = quality.train(tables["documents"], tables["labels"])
    score = lambda text: quality.attend(model, *quality.passages([(text or "").encode()]))[0][0]
    good = [(i, t) for i, t in docs if score(t) >= quality.THRESHOLD]
    _, component = brute_components(good, 80, 5)
    first = [(i, t) for i, t in good if component[i] == i]
    wanted = [shingles(t, 5) for _, t in items]
    clean = []
    for i, t in first:
        held = [(shingles(t, min(5, len((x or "").split()) or 5)) & w, w) for (_, x), w in zip(items, wanted)]
        if not any(w and 100 * len(both) >= 80 * len(w) for both, w in held):
            clean.append((i, t))
    votes = pii.train(spark.createDataFrame(clean, "doc_id long, text string"))
    masked = {i: t and pii.masked(t, pii.all_spans(t, votes)[1]) for i, t in clean}
    assert len(docs) > len(good) > len(first) >= len(clean) > 0

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in masked.items()}
    pieces: dict = {}
    for r in corpus_pipeline.run(spark, SF_DIR).collect():
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"]))
    assert pieces.keys() == ids.keys()
    for i, parts in pieces.items():
        at = 0
        for start, length, crc in sorted(parts):
            part = np.array(ids[i][at : at + length], "<u4")
            assert (start, crc) == (at, zlib.crc32(part.tobytes()))
            at += length
        assert at == len(ids[i])
