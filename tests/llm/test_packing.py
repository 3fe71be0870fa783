import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from shiftwise.llm.packing import LENGTH, Encoder, assign, pack, public_paths

ODD = ["it's we'll I've", "a  b\n\n c\t\r\n", "x\x1cy\x85z\xa0w", "½ 3² 1234567 café ÀÉ ǅ", "日本語 текст   ok", "😀😀 a",
       "<|endoftext|> a", "", " ", "\n", "   lead", "trail   ", "'s 'S", "a're", "¡hola! ¿qué? «x»", "A" * 3000, "_a_ --- ..."]


def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_the_tokenizers(spark):
    whole, own = reference(), Encoder(*public_paths())
    texts = ODD + [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rng = random.Random(2)
    alphabet = "ab é'st½1²\t\n \x1c\x1f\xa0\x85.,<|>ñ-"
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(2000)]
    for t in texts:
        assert np.frombuffer(own(t), "<u2").tolist() == [*whole.encode(t, add_special_tokens=False).ids, 1], t


def test_assign_descending_to_lowest_cost():
    got = assign(np.array([1500, 1000, 900, 600, 60, 36]))
    assert sum(s for _, _, s, _ in got) == 4096
    # 1500 opens one sequence, 1000 the other, 900 joins 1000; 600 fits nowhere and is cut at the end
    assert [x[3] for x in got if x[0] < 3] == [0, 1, 1] and [x[0] for x in got[-2:]] == [3, 3]


def test_pack_is_exact(spark, docs):
    rng = random.Random(5)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, "word " * rng.randrange(900)) for i in range(60)]
    rows += [(300, "long text here " * 9000), (301, None), (None, "null id"), (5, "again"), (5, "again")]
    got = pack(docs(rows), group=20).collect()
    whole = reference()
    want = defaultdict(int)
    for r in rows:
        ids = np.array([*whole.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        want[r[0], len(ids)] += len(ids)
    have = defaultdict(int)
    ids_of = {r[0]: np.array([*whole.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4") for r in rows}
    sequences = defaultdict(list)
    for r in got:
        have[r["doc_id"], r["doc_tokens"]] += r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        if r["doc_id"] != 5:
            ids = ids_of[r["doc_id"]]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
    assert have == want
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= LENGTH
    # each group (20 documents a group) pads less than one sequence
    assert LENGTH * len(sequences) - sum(want.values()) < LENGTH * 5
    assert pack(docs([])).count() == 0
