import io
import struct
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import ODD, frame, prose
from tollgate.llm import token_output as op7
from tollgate.llm.textarrays import blocks



def thue_morse(n):
    """Two different words of 2**n letters that polynomial hashes modulo 2**64 cannot tell apart."""
    x, y = "a", "b"
    for _ in range(n):
        x, y = x + y, y + x
    return [x, y]


PATH = public_tokenizers.path(op7.TOKENIZER)
TEXTS = [None, "", " ", "  two  spaces\n\n\tmixed \r\n ends ", "don't we'll it's 'tis O'Neil's", "a1b2 c3,d4 e;f (g) [h]!?", "x\u00a0y\u3000z \u2003 w",
         "<|endoftext|> in the middle <|endoftext|>", "é ü ß — “q” …", "漢字 かな 漢字", "\x00\x1f\x7f ctl \x1cx", "🙂 🙂🙂 e\u0301", "A" * 3000,
         " ".join(prose(3, 5000)), "tail space ", "***&&& %%% re*** THE!! x|y", "''''s 'll '' 're", "1'2'3 a'b'c",
         *(w for n in range(2, 13) for w in thue_morse(n)), "abcdefgh abcdefghi abcdefghabcdefgh abcdefghabcdefghi", "abcdefg\x00 abcdefg"]


@pytest.mark.parametrize("size", [1 << 20, 40])
def test_pieces_encode_like_whole_texts(size):
    encoder, plain = op7.PieceEncoder(PATH), Tokenizer.from_file(PATH)
    for _ in range(2):  # the second time from memory
        out = []
        for block in blocks(pa.array(TEXTS), size):
            ids, lengths = encoder.encode(block)
            out += [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])]
        assert out == [plain.encode(t or "", add_special_tokens=False).ids + [0] for t in TEXTS]


@pytest.mark.parametrize("bits", [False, True])
def test_shard_round_trip(bits):
    r, stream = np.random.default_rng(0), io.BytesIO()
    w = op7.ShardWriter(stream, bits)
    docs = [(i if i % 5 else None, r.integers(0, 2 ** 32, n, dtype=np.uint32)) for i, n in enumerate([1, 0, 70_000, 3, 200_000, 65_536, 0, 2])]
    for doc, ids in docs:
        w.append(np.array([doc or 0]), np.array([doc is None]), ids, np.array([len(ids)]))
    w.close()
    got = list(op7.ShardReader(pa.PythonFile(io.BytesIO(stream.getvalue()), "r")).documents())
    assert [d for d, _ in got] == [d for d, _ in docs]
    assert all(np.array_equal(a, b) for (_, a), (_, b) in zip(got, docs))
    with pytest.raises(ValueError):
        op7.ShardReader(pa.PythonFile(io.BytesIO(stream.getvalue()[:-1]), "r"))


@pytest.mark.parametrize("bits", [False, True])
def test_token_output_reads_back_what_the_library_gives(spark, bits):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(40 + (i or 0), t) for i, t in ODD if i]
    got = sorted(op7.token_output(frame(spark, rows), bits=bits).collect(), key=lambda r: r.start)
    plain, start = Tokenizer.from_file(PATH), 0
    assert [r.doc_id for r in got] == sorted(i for i, _ in rows)
    by_id = {}
    for i, t in rows:
        by_id.setdefault(i, []).append(plain.encode(t or "", add_special_tokens=False).ids + [0])
    for r in got:
        options = {(len(x), zlib.crc32(struct.pack(f"<{len(x)}I", *x))) for x in by_id[r.doc_id]}
        assert r.start == start and (r.n_tokens, r.ids_crc32) in options
        start += r.n_tokens


def test_token_output_null_ids_first_and_empty(spark, empty):
    got = op7.token_output(frame(spark, [(5, "a b"), (None, "c"), (None, "d e f")])).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 5] and got[0].start == 0
    assert op7.token_output(empty).count() == 0
