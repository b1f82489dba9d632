"""Token files: exact round trip with the library, random access, odd rows."""
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from riskgraph.llm import tokens as T
from riskgraph.llm.pretokens import Coder
from tests.conftest import SF0001
from tests.llm.conftest import ODD

PATH = public_tokenizers.path(T.TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def model(rows, library):
    at, out = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, T.END]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_coder_equals_library_on_random_text(library):
    rnd = random.Random(5)
    letters = list("ab c\n\t  12!?é日ß'<|>　 \x85\x1c🙂AZ$%")
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 2, 9, 60]))) for _ in range(1500)]
    texts += ["x <|endoftext|> y", "", "  ", " a  ", "a \n b", "\n\n a", "word7, " * 60000]
    coder = Coder(PATH)
    for k in range(0, len(texts), 41):
        part = texts[k:k + 41]
        for a, b in zip(coder.encode(part), library.encode_batch(part, add_special_tokens=False), strict=True):
            assert a.tolist() == b.ids


def test_query_equals_library(spark, library):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    got = sorted(map(tuple, T.op2_tokens(spark, SF0001).collect()))
    assert got == model(rows, library)


def test_odd_rows_and_small_files(make, library):
    rows = [(None, "first by rule"), (3, ""), (1, None), (9, "long " * 5000), (2, " \n")]
    found = T.token_index(make(rows), PATH, sequence=16, file_ids=64).collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == model(rows, library)
    repeated = T.token_index(make([*ODD, (4, "two")]), PATH, sequence=8).collect()
    assert sorted(r["n_tokens"] for r in repeated) == sorted(m[2] for m in model([*ODD, (4, "two")], library))
    assert len({r["start"] for r in repeated}) == len(repeated)
    assert T.token_index(make([]), PATH).collect() == []


def test_random_access_without_copies():
    ids = np.arange(1000, dtype=np.uint16)
    data = T.file_bytes(ids, [(5, 0, 600), (6, 600, 400)], 64, pa.uint16(), {"part": 0, "seq": 0})
    f = T.SequenceFile(pa.BufferReader(data))
    row, mask = f.row(9)
    assert row.tolist() == list(range(576, 640)) and mask.all()
    assert row.base is not None and not row.flags.writeable
    last, mask = f.row(15)
    assert mask.sum() == 1000 - 15 * 64 and last[mask].tolist() == list(range(960, 1000))
    assert [(d, at, x.tolist()) for d, at, x in f.texts()] == [(5, 0, list(range(600))), (6, 600, list(range(600, 1000)))]
