"""Token records: round trip against whole-text encoding, checksums, index, order."""

import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pitwall.llm import queries, records

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(records.tokenizer_path())


def expected(tokenizer, rows):
    """(doc_id, start, n_tokens, crc) from encoding whole texts in order."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.asarray([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_is_whole_text_encoding(spark, small_dir, tokenizer):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = queries.QUERIES["op13_token_records"](spark, small_dir).orderBy("start").collect()
    assert [tuple(r) for r in got] == expected(tokenizer, docs)


ODD = ["a\x1cb \x1d\x1e", "no break em 　wide", "it's I'LL we 've", "é ́mark a ̸= ≮",
       "<|endoftext|> x<|startoftext|>y", "tab\there\r\nand\x0bthere\x0c", "ΑΣ ΟΔΟΣ. ÉÀ", "한가 각", "a" * 5000,
       "...!!?? (a.b,c)--d", "", "   ", "0123 4,5.6", "\U0001f468‍\U0001f469 ﻿bom​"]


def test_runs_give_the_ids_of_whole_texts(tokenizer):
    encoder = records.Encoder(records.tokenizer_path())
    odd = ODD + [f"{w}{m}" for w in ("dog", "DON'T", "É", "x'", "9", "a.b", "it's", "<|endoftext|>", "e\u0301")
                 for m in (".", ",", "!?", "...", ";:", "'.", ".'", ".\u0338")]
    odd += [" ".join(odd), "\n".join(odd[::-1])]
    for text, ids in zip(odd, encoder.encode(pa.array(["left out", *odd]).slice(1)), strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2], text


def test_many_files_ties_and_nulls(spark, table, odd_rows, tokenizer, tmp_path):
    rows = odd_rows + [(7, f"copy {i % 3}", "en", "a") for i in range(50)]
    folder = f"file://{tmp_path}/set"
    records.write_records(table(rows), folder, file_bytes=20_000)
    got = records.read_records(spark, folder).orderBy("start").collect()
    assert len({r.file for r in records.read_index(spark, folder).collect()}) > 5
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x))
    ids = {t: np.asarray([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for _, t, *_ in rows}
    assert sorted((repr(r.doc_id), bytes(r.ids)) for r in got) == sorted((repr(i), ids[t]) for i, t, *_ in rows)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
    assert all(len(r.ids) == 4 * r.n_tokens for r in got)


def test_reader_by_index(spark, table, tmp_path, tokenizer):
    folder = f"file://{tmp_path}/set"
    records.write_records(table([(i, f"text number {i}", "en", "a") for i in range(40)]), folder, file_bytes=200)
    reader = records.RecordReader(folder)
    for row in records.read_index(spark, folder).collect()[::-3]:
        doc_id, ids = reader[row.file, row.offset, row.length]
        assert doc_id == row.doc_id
        assert ids.tolist() == [*tokenizer.encode(f"text number {doc_id}", add_special_tokens=False).ids, 2]


def test_empty_table(spark, table, tmp_path):
    folder = f"file://{tmp_path}/set"
    records.write_records(table([]), folder)
    assert records.read_records(spark, folder).collect() == []


def test_frame_and_mask():
    data = records.frame(-5, struct.pack("<3H", 1, 2, 40000), 2) + b"\n" + records.frame(None, b"", 4) + b"\n"
    first, second = records.records(data)
    assert (first[0], first[2], first[3].tolist()) == (0, -5, [1, 2, 40000])
    assert (second[0], second[2], second[3].tolist()) == (first[1], None, [])
    assert records.unmasked(records.masked(b"abc")) == zlib.crc32(b"abc") != records.masked(b"abc")


@pytest.mark.parametrize("at", [0, 8, 15, 25, -1])
def test_damage_is_found(at):
    data = bytearray(records.frame(1, b"\x01\x00\x02\x00", 2) + b"\n")
    data[at] ^= 1
    with pytest.raises(ValueError):
        list(records.records(bytes(data)))
    with pytest.raises(ValueError):
        list(records.records(bytes(records.frame(1, b"", 2))))
