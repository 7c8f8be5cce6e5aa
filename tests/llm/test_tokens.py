import zlib

import numpy as np
from samples import ODD
from hypothesis import given, settings
from hypothesis import strategies as st

from fairground.llm import packing, tokens


def direct(tokenizer, text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer).encode(text or "", add_special_tokens=False).ids + [1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_round_trip(spark, make, tokenizer):
    docs = make(*ODD)
    got = {r.doc_id: r for r in tokens.encode_documents(spark, docs.union(docs.where("doc_id = 3")), tokenizer, 1).collect()}
    rows = tokens.encode_documents(spark, docs, tokenizer, 1).orderBy("doc_id").collect()
    before = 0
    for r, text in zip(rows, ODD):
        ids = direct(tokenizer, text)
        assert (r.start, r.n_tokens, r.ids_crc32) == (before, len(ids), crc(ids))
        before += len(ids)
    assert len(got) == len(ODD) and len(rows) == len(ODD)


def test_selective_read(spark, make, tokenizer, tmp_path):
    tokens.write_tokens(make(*ODD), f"{tmp_path}/files", tokenizer, 1)
    one = tokens.read_tokens(spark, f"{tmp_path}/files").where("doc_id = 4").select("tokens")
    assert one.first()[0] == direct(tokenizer, ODD[4])
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,4)]" in one._jdf.queryExecution().toString()


def test_empty_table(spark, make, tokenizer):
    docs = make(*ODD).limit(0)
    assert tokens.encode_documents(spark, docs, tokenizer, 1).count() == 0
    assert packing.pack_documents(spark, docs, tokenizer, 1).count() == 0


def test_packing(spark, make, tokenizer):
    rows = packing.pack_documents(spark, make(*ODD, *["a b c"] * 50), tokenizer, 1, max_len=64).collect()
    by_doc, by_pack = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_pack.setdefault(r.sequence_id, []).append(r)
    for doc, text in enumerate([*ODD, *["a b c"] * 50]):
        ids, at = direct(tokenizer, text), 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), crc(ids[at : at + r.length]))
            at += r.length
        assert at == len(ids)
    for pack in by_pack.values():
        at = 0
        for r in sorted(pack, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert sorted(by_pack) == list(range(len(by_pack)))


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 5000), max_size=30))
def test_plan(histogram):
    plan = packing.plan_packs(histogram, 64)
    placed = {}
    for lengths, count in plan:
        assert sum(lengths) <= 64
        for n in lengths:
            placed[n] = placed.get(n, 0) + count
    assert placed == histogram
    total, packs = sum(n * c for n, c in histogram.items()), sum(c for _, c in plan)
    assert packs <= 2 * total / 64 + 1


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("abcXYZéÉßİ'’.,!?-_ \t\n ̱́½²ﬁ日т0123")), max_size=30), min_size=1, max_size=5))
def test_encoder_equals_library(texts):
    import public_tokenizers
    import pyarrow as pa

    own = tokens.encoder(public_tokenizers.path("word_bpe_49k.json"))
    ids, cuts = own.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])] == [own.tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_files_are_laid_out_as_said(spark, make, tokenizer, tmp_path):
    """Encodings, statistics and page indexes of what is written, read by another library."""
    import pyarrow.parquet as pq

    texts = [f"word{i % 50} and another text {i} " * 40 for i in range(12_000)]
    tokens.write_tokens(make(*texts).coalesce(1), f"{tmp_path}/files", tokenizer, 1)
    seen = []
    for part in sorted((tmp_path / "files").glob("part-*.parquet")):
        meta = pq.ParquetFile(part).metadata
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c) for c in range(meta.num_columns)}
            by_kind = {name.split(".")[0]: c for name, c in columns.items()}
            assert "DELTA_BINARY_PACKED" in by_kind["doc_id"].encodings and "DELTA_BINARY_PACKED" in by_kind["n_tokens"].encodings
            assert "RLE_DICTIONARY" in by_kind["tokens"].encodings and by_kind["tokens"].has_dictionary_page
            assert by_kind["doc_id"].has_offset_index and by_kind["doc_id"].has_column_index
            # Row groups cover ranges of ids that do not overlap, so that a reader can pass over them.
            seen.append((by_kind["doc_id"].statistics.min, by_kind["doc_id"].statistics.max))
    assert sorted(seen) == seen and all(a[1] < b[0] for a, b in zip(seen, seen[1:])) and (seen[0][0], seen[-1][1]) == (0, 11_999)


def pack_slowly(histogram, room):
    """One piece at a time, longest first, each onto the pack that is shortest among those with room."""
    packs = []
    for length in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
        fits = [p for p in packs if sum(p) + length <= room]
        if fits:
            min(fits, key=sum).append(length)
        else:
            packs.append([length])
    return packs


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 12), max_size=10))
def test_plan_is_shortest_pack_first(histogram):
    plan = packing.plan_packs(histogram, 20)
    got = sorted(sum(lengths) for lengths, count in plan for _ in range(count))
    assert got == sorted(map(sum, pack_slowly(histogram, 20)))


def test_null_and_shared_ids_are_packed(spark, make, tokenizer):
    docs = make("a b", None, "c").withColumns({"file": __import__("pyspark.sql.functions", fromlist=["lit"]).lit("own")})
    odd = docs.unionByName(docs.selectExpr("cast(null as long) as doc_id", *[f"`{c}`" for c in docs.columns if c != "doc_id"]))
    rows = packing.pack_documents(spark, odd, tokenizer, 1, max_len=8).collect()
    assert len(rows) == 6 and sorted((r.doc_id is None, r.doc_tokens) for r in rows) == [(False, 1), (False, 2), (False, 3), (True, 1), (True, 2), (True, 3)]
    assert tokens.encode_documents(spark, odd, tokenizer, 1).count() == 6
