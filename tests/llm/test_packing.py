import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from credscope.llm import op04_packing as op

from .conftest import invented


def check(pieces, texts, limits, loss_from=None):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = defaultdict(list)
    for i, t, *_ in texts:
        want[i].append(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4"))
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
        by_doc[p.doc_id].append(p)
        assert any(p.ids_crc32 == zlib.crc32(x[p.start : p.start + p.length].tobytes()) and len(x) == p.doc_tokens for x in want[p.doc_id])
    for i, x in want.items():
        assert sum(p.length for p in by_doc[i]) == sum(map(len, x))
        if len(x) == 1:
            assert [p.start for p in sorted(by_doc[i], key=lambda p: p.start)] == list(np.cumsum([0, *(p.length for p in sorted(by_doc[i], key=lambda p: p.start))])[:-1])
    padding = 0
    for ps in by_sequence.values():
        ps.sort(key=lambda p: p.offset)
        assert [p.offset for p in ps] == list(np.cumsum([0, *(p.length for p in ps)])[:-1])
        total = sum(p.length for p in ps)
        assert total <= limits.capacity and len(ps) <= limits.max_segments and ps[0].sequence_tokens == total
        loss = sum(p.length - min(p.length, max(0, (loss_from or {}).get(p.doc_id, 0) - p.start)) for p in ps)
        assert loss <= limits.max_loss
        padding += 0 if total & (total - 1) == 0 else limits.capacity - total
    return padding


def test_ids_and_padding(make_docs):
    rows = [(i, t) for i, t in enumerate(invented(400, seed=7))] + [(900, " ".join(invented(80, seed=8))), (901, "a  b\n\n c\t\td   "), (902, "<|endoftext|>!"[2:])]
    assert check(op.pack(make_docs(rows), op.default_ranks()).collect(), rows, op.Limits()) == 0


def test_added_token_in_texts(make_docs):
    end = "<|endoftext|>"
    texts = [f"a {end} b", f"{end}start", f"the end{end}", end, end * 3, f"a  {end}  b\n\n{end} \n c", f"<|endoftext{end}|> {end[:-1]}", f"<|ENDOFTEXT|> <{end}>"]
    rows = list(enumerate(texts))
    assert op.encoder(op.default_ranks())(texts[0]) == [64, 220, 50256, 275]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert [op.encoder(op.default_ranks())(t) for t in texts] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert check(op.pack(make_docs(rows), op.default_ranks()).collect(), rows, op.Limits()) == 0


def test_three_limits(make_docs):
    rows = [(i, t) for i, t in enumerate(invented(300, seed=9))] + [(i, "x") for i in range(300, 500)]
    limits = op.Limits(capacity=256, max_segments=4, max_loss=100)
    lead = {i: (i * 37) % 150 for i, _ in rows}
    docs = make_docs(rows).withColumn("lead", (F.col("doc_id") * 37) % 150)
    check(op.pack(docs, op.default_ranks(), limits, "lead").collect(), rows, limits, lead)


def test_odd_rows(make_docs, odd_rows):
    assert check(op.pack(make_docs(odd_rows), op.default_ranks()).collect(), odd_rows, op.Limits()) == 0
    assert op.pack(make_docs([]), op.default_ranks()).collect() == []


def test_heuristic_takes_the_best_fit():
    packer = op.Packer(op.Limits(capacity=10, max_segments=9, max_loss=10))
    for key, n in (("a", 4), ("b", 7), ("c", 3)):
        packer.add(key, np.arange(n, dtype="<u4"))
    packer.finish()
    assert [(r[0], len(r[2]), r[4]) for r in packer.done] == [("b", 7, 0), ("c", 3, 0), ("a", 4, 1)]
