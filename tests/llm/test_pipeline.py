from __future__ import annotations

from collections import Counter, defaultdict

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline as pipeline
from tradeloom.llm import packing, pii

from .test_mixing import taken, targets
from .test_near_dedup import brute_force as classes
from .test_packing import reference_ids
from .test_quality import features, kept

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_equal_brute_force(spark, tiny, tmp_path):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    before = docs.collect()
    for name, stage in pipeline.STAGES[:-1]:
        result = stage(spark, docs, tiny)
        assert result.columns == COLUMNS and result.dtypes == docs.dtypes
        result.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = docs.collect()
        if name == "quality rules":
            assert sorted(after) == sorted(r for r in before if kept(features(r.text)))
        elif name == "near duplicates":
            rows = sorted(before, key=lambda r: r.doc_id)
            assert sorted(after) == [r for i, r in enumerate(rows) if classes([x.text for x in rows])[i] == i]
        elif name == "personal data":
            assert [r.doc_id for r in sorted(after)] == [r.doc_id for r in sorted(before)]
            for old, new in zip(sorted(before), sorted(after), strict=True):
                assert not pii.pattern_spans(new.text) and new.n_chars == len(new.text)
                assert (old.text == new.text) or pii.pattern_spans(old.text) or "<" in new.text
        else:
            rows = [(r.doc_id, r.source, len(r.text.split())) for r in before]
            totals = defaultdict(int)
            for _, source, size in rows:
                totals[source] += size
            words = Counter()
            for r in after:
                words[r.doc_id] += len(r.text.split())
            assert words == Counter({r[0]: n for r, n in zip(rows, taken(rows, totals, targets(totals)), strict=True) if n})
        before = after
    packed = pipeline.STAGES[-1][1](spark, docs, tiny).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert sum(r.length for r in packed) == sum(len(reference_ids(library, r.text)) for r in before)
    ends = Counter()
    for r in packed:
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= packing.CAPACITY
    whole = __spark_entry__.queries()["pipeline"](spark, tiny).collect()
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in whole) == Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in packed)
