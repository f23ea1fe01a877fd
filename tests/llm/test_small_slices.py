"""Texts come to a Python worker in small record batches and are worked on in small slices."""

import os

import pytest

from siltbed.llm import bpe, quality_model, queries


def scores(docs):
    return quality_model.quality_scores(docs, quality_model.BagModel({}, 0.5))


@pytest.mark.parametrize("module, work", [(quality_model, scores), (bpe, queries.encoded)])
def test_workers_hold_little_text(documents, tmp_path, monkeypatch, module, work):
    cut, seen = module.slices, str(tmp_path)

    def note(kind, rows):
        import os
        import tempfile

        os.close(tempfile.mkstemp(prefix=f"{kind}-{rows.column('text').nbytes}-", dir=seen)[0])
        return rows

    def noted(batches, *sizes):
        for part in cut((note("batch", b) for b in batches), *sizes):
            yield note("slice", part)

    monkeypatch.setattr(module, "slices", noted)
    texts = [f"{i} " + "some more words " * 1250 for i in range(900)]
    assert work(documents(texts)).count() == 900
    largest = {kind: max(int(f.split("-")[1]) for f in os.listdir(seen) if f.startswith(kind)) for kind in ("batch", "slice")}
    assert largest["batch"] < 3_000_000
    assert largest["slice"] < 150_000
