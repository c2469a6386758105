"""Tokens, archives, entry points and the pipeline."""

import collections
import io
import os
import uuid
import zipfile
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from intervalflow.llm import queries, sentencepieces as sp, tokenfile, warc, wordmap
from intervalflow.session import scratch_path

TEXTS = ["", None, " ", "Hello World's <|endoftext|> café  café\n\n日本語 x", "a" * 300, "the cat, the dog. " * 40, "▁x ▁▁", " " * 37 + "x", "\ta\r\nb",
         "'s it's I'm don't", "é \xa0 \x1c  ", "🧪🧪 \x00"]


def docs(spark):
    return spark.createDataFrame([(i, t, 1, "k") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], 2, "k"), (None, "null id", 3, "k")],
                                 "doc_id long, text string, ids int, part string")


def _proto():
    return open(public_tokenizers.path(sp.MODEL), "rb").read()


@pytest.mark.parametrize("words", [wordmap.DICTIONARY_WORDS, 5])
def test_sentencepiece_equals_the_library(spark, words):
    import sentencepiece
    model, lib = sp.Model.load(), sentencepiece.SentencePieceProcessor(model_proto=_proto())
    out = sp.decode(sp.encode(docs(spark), model=model, dictionary_words=words), model=model).collect()
    assert len(out) == len(TEXTS) + 2
    for r in out:
        assert list(r.ids) == lib.encode(r.text or ""), r.text
        assert r.decoded == (r.text or "").replace("▁", " ") and r.part == "k"
    fused = sp.encode(docs(spark), model=model, dictionary_words=words, decoded_col="decoded").collect()
    assert sorted(map(str, fused)) == sorted(map(str, out))
    assert sp.encode(docs(spark).limit(0), model=model).count() == 0


def test_dictionary_is_bounded_by_bytes(spark, monkeypatch):
    """Long words, and words beyond the bytes, take the join; a frequent short word stays however long the others are."""
    import sentencepiece
    kind = np.dtype("<u2")
    rows = [("the", 90, [7])] + [(f"line {i} " * 40, 1, list(range(300))) for i in range(50)] + [(f"w{i}", 2, [1, i]) for i in range(20)]
    words = spark.createDataFrame(rows, "chunk string, n long, ids array<int>")
    assert wordmap.dictionary(words, 100, kind)[4] == 0
    monkeypatch.setattr(wordmap, "DICTIONARY_BYTES", 1000)
    hashes, checks, to, flat, missing = wordmap.dictionary(words, 100, kind)
    assert missing == 50 and len(hashes) == 21 and wordmap.WORD_BYTES * len(hashes) + flat.nbytes <= 1000
    monkeypatch.setattr(wordmap, "DICTIONARY_BYTES", 100)
    assert wordmap.dictionary(words, 100, kind)[3].tolist() == [7]
    monkeypatch.setattr(wordmap, "DICTIONARY_BYTES", 2000)
    texts = TEXTS + ["日本語の長い文" * 60 + str(i) for i in range(12)] + ["the cat"] * 5
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    lib = sentencepiece.SentencePieceProcessor(model_proto=_proto())
    for r in sp.encode(table).collect():
        assert list(r.ids) == lib.encode(r.text or ""), r.text


def thue_morse(n):
    """A word of a and b and its complement: the standard collision of polynomial hashes modulo powers of two."""
    word = "".join("ab"[bin(i).count("1") & 1] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_that_collide_elsewhere_have_their_own_ids(spark):
    import sentencepiece
    from tokenizers import Tokenizer
    lib, coder = sentencepiece.SentencePieceProcessor(model_proto=_proto()), Tokenizer.from_file(public_tokenizers.path(tokenfile.VOCABULARY))
    texts = dict(enumerate([w for n in (16, 64, 1024, 2048) for w in thue_morse(n)]))
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    assert all(list(r.ids) == lib.encode(r.text) for r in sp.encode(table).collect())
    path = scratch_path(spark, "morse")
    tokenfile.write_tokens(table, path)
    for r in tokenfile.read_tokens(spark, path).collect():
        assert list(r.ids) == coder.encode(texts[r.doc_id], add_special_tokens=False).ids + [tokenfile.END_ID]


def test_equal_hashes_are_told_apart_by_the_check(spark, monkeypatch):
    """Every word gets one hash; the other bits of the digest must do."""
    plain = wordmap.tx.Hasher.digests

    def crowded(self, data, starts, ends):
        h, _ = plain(self, data, starts, ends)
        return h & np.uint64(1 << 63), h.astype(np.uint32)
    rows = [("one", 5, [1]), ("two", 4, [2, 2]), ("three", 3, [3]), ("four", 2, [4])]
    data = np.frombuffer(b"twofouronetwosix", np.uint8)
    starts, ends = np.array([0, 3, 7, 10, 13]), np.array([3, 7, 10, 13, 16])
    words = np.frombuffer("".join(w for w, *_ in rows).encode(), np.uint8)
    cut = np.cumsum([0] + [len(w) for w, *_ in rows])
    monkeypatch.setattr(wordmap.tx.Hasher, "digests", crowded)
    hasher = wordmap.tx.Hasher()
    h, c = hasher.digests(words, cut[:-1], cut[1:])
    order = np.argsort(h)
    place = wordmap._find(*hasher.digests(data, starts, ends), h[order], c[order], wordmap._index(h[order]))
    assert [rows[order[p]][0] if p >= 0 else None for p in place] == ["two", "four", "one", "two", None]
    first, back = wordmap._distinct(*hasher.digests(data, starts, ends))
    assert len(first) == 4
    assert sorted(back.tolist()) == [1, 1, 1, 2]          # counts: "two" occurs twice


def test_sentencepiece_pieces_encode_to_themselves(spark):
    """The fold replays the merges because every piece's own merges have better scores."""
    import sentencepiece
    model, lib = sp.Model.load(), sentencepiece.SentencePieceProcessor(model_proto=_proto())
    words = [p.replace("▁", " ") for p, k in zip(model.pieces, model.kinds) if k == "piece"][::7] + ["x" * 64, "ab" * 70, "-" * 33 + "=" * 40, " " * 70]
    table = spark.createDataFrame([(w, 1) for w in words], "chunk string, n long").repartition(4, "chunk")
    for r in sp.encode_chunks(table, model).collect():
        # The library puts a space in front; a line feed, which is a byte piece here, keeps it off the chunk.
        assert list(r.ids) == lib.encode("\n" + r.chunk)[2:], r.chunk


def test_unigram_viterbi_finds_the_best_path(spark):
    """The model's pieces as a unigram model (its type is field 3 of the trainer's message), against the library's best path."""
    import sentencepiece
    proto = _proto()
    at = proto.index(b"\x18\x02", proto.rindex(b"\x12\xe8\x01\n"))
    proto = proto[:at] + b"\x18\x01" + proto[at + 2:]
    model, lib = sp.Model.load(proto=proto), sentencepiece.SentencePieceProcessor(model_proto=proto)
    assert model.algorithm == sp.UNIGRAM
    words = ["the", "thinter", "onening", "a", "international", "xyzzy", "don't", "étrangère"]
    table = spark.createDataFrame([(" " + w, 1) for w in words], "chunk string, n long").repartition(2, "chunk")
    score = np.array(model.scores)
    for r in sp.encode_chunks(table, model).collect():
        best = lib.nbest_encode(r.chunk[1:], nbest_size=20)[0]
        assert "".join(model.pieces[i] for i in r.ids) == "".join(model.pieces[i] for i in best)
        assert score[r.ids].sum() == pytest.approx(score[best].sum())


@pytest.mark.parametrize("delta,words", [(False, wordmap.DICTIONARY_WORDS), (True, 5)])
def test_token_files(spark, delta, words):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(public_tokenizers.path(tokenfile.VOCABULARY))
    path = scratch_path(spark, "tokens")
    tokenfile.write_tokens(docs(spark), path, delta=delta, dictionary_words=words)
    got = tokenfile.digests(tokenfile.read_tokens(spark, path)).collect()
    rows = sorted(docs(spark).collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
    start, want = 0, collections.Counter()
    for r in rows:
        ids = np.array(lib.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        want[r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())] += 1
        start += len(ids)
    assert collections.Counter(tuple(r) for r in got) == want
    meta = tokenfile.read_metadata(spark, path)
    assert {(r.doc_id, r.start, r.n_tokens) for r in meta.collect()} == {k[:3] for k in want}
    assert {r.doc_id for r in tokenfile.read_tokens(spark, path, 3, 5).collect()} == {3, 4, 5}
    assert "ids" not in meta._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    file = next(f"{path}/{f}" for f in sorted(os.listdir(path)) if f.startswith("part-"))
    chunk = pq.ParquetFile(file).metadata.row_group(0).column(4)
    assert any("DELTA" in e for e in chunk.encodings) if delta else chunk.has_dictionary_page
    empty = scratch_path(spark, "tokens")
    tokenfile.write_tokens(docs(spark).limit(0), empty)
    assert tokenfile.read_tokens(spark, empty).count() == 0


def pages(spark):
    big, other = "é" * 700, "<p>" + "x" * 2000
    rows = [(1, "http://a/1", big), (9, "u\r\nv", big), (4, None, big), (2, "u", "small"), (3, "u", "small"), (5, "u", None), (6, "u", ""),
            (None, "u", big), (7, "u", other), (8, "u", other), (8, "u", other), (10, "u", "y" * 999), (11, "u", "y" * 999), (12, "u", "z" * 300_000)]
    return spark.createDataFrame([(*r, "d") for r in rows], "page_id long, url string, html string, digest string")


@pytest.mark.parametrize("zip64,size", [(False, 1 << 27), (True, 200)])
def test_archives_round_trip(spark, zip64, size):
    manifest = warc.write_archives(warc.plan_records(pages(spark)), scratch_path(spark, "archives"), size, zip64)
    got = warc.read_archives(manifest).collect()
    assert len(got) == 14
    by = {r.page_id: r for r in got}
    assert {i: (r.record_type, r.refers_to) for i, r in by.items() if r.record_type == "revisit"} == {1: ("revisit", 9), 4: ("revisit", 9), 7: ("revisit", 8)}
    assert by[1].payload_bytes == 1400 and by[1].payload_digest == by[9].payload_digest and by[1].payload is None
    assert by[5].payload_bytes == 0 and by[None].record_type == "response" and bytes(by[12].payload) == b"z" * 300_000
    one = warc.read_record(by[12].archive, by[12].offset, by[12].length)
    assert one[0] == 12 and one[6] == b"z" * 300_000
    path = by[12].archive.removeprefix("file://")
    with zipfile.ZipFile(path.removeprefix("file:")) as z:                # another reader agrees
        assert z.namelist() == [warc.DATA, warc.INDEX] and z.testzip() is None
        assert all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())
    none = warc.write_archives(warc.plan_records(pages(spark).limit(0)), scratch_path(spark, "archives"))
    assert none.count() == 0 and warc.read_archives(none).count() == 0


class Ranges(io.BytesIO):
    def read_at(self, n, offset):
        return self.getvalue()[offset:offset + n]


@pytest.mark.parametrize("zip64", [False, True])
def test_zip_directory_of_other_writers(zip64):
    sink = Ranges()
    if zip64:
        w = warc.ZipWriter(sink, True)
        w.member("a", [b"one", b"two"])
        w.member("b", [])
        w.close()
    else:
        with zipfile.ZipFile(sink, "w") as z:
            z.comment = b"a comment PK\x05\x06 with a false mark"
            z.writestr("a", b"onetwo")
            z.writestr("b", b"")
    members = warc.zip_members(sink, len(sink.getvalue()))
    place, n, method = members["a"]
    assert sink.read_at(n, place) == b"onetwo" and method == 0 and members["b"][1] == 0
    with pytest.raises(ValueError):
        warc.zip_members(Ranges(b"x" * 100), 100)


def test_damaged_records_are_refused():
    raw = warc.record(1, "u", b"payload", "0" * 40, None)
    with pytest.raises(ValueError):
        warc.parse_record(raw)


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    import corpus_pipeline
    from conftest import SF_SMALL
    from intervalflow.llm import minhash, pii, quality
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    good = quality.quality_scores(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet")).where("predicted = 1")
    ids = {r.doc_id for r in good.collect()}
    kept = {r.id for r in minhash.near_duplicates(good.select("doc_id", "text")).collect() if r.kept}
    text = {r.doc_id: r.text for r in docs.collect()}
    replace = pii.replacer()
    assert 0 < len({r.doc_id for r in out}) and {r.doc_id for r in out} <= kept <= ids
    for r in out:
        assert r.text == replace(text[r.doc_id])[0].replace("▁", " ") and r.n_tokens == len(r.ids)
    again = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert collections.Counter(r.doc_id for r in out) == collections.Counter(r.doc_id for r in again)
    assert max(collections.Counter(r.doc_id for r in out).values()) <= 3
    for name, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs.limit(0), SF_SMALL).columns == docs.columns, name


def test_near_dedup_drops_rows_not_ids(spark):
    """An id with two texts loses the copy only; a near copy of its other text is found; rows that repeat id and text become one."""
    import corpus_pipeline
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (5, a), (5, b), (7, b + " end"), (9, c), (9, c), (12, c), (None, a), (3, None), (3, ""), (20, "alone here")]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    got = corpus_pipeline.near_dedup(spark, docs, "")
    assert got.columns == docs.columns
    assert collections.Counter((r.doc_id, r.text) for r in got.collect()) == collections.Counter(
        [(1, a), (5, b), (9, c), (None, a), (3, None), (3, ""), (20, "alone here")])
    unique = docs.where("doc_id IN (1, 7, 12)").dropDuplicates(["doc_id"]).unionByName(docs.limit(1).withColumn("doc_id", F.lit(2).cast("long")))
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, unique, "").collect()) == [1, 7, 12]


def test_scratch_needs_a_shared_folder_on_clusters(spark):
    assert uuid.UUID(scratch_path(spark, "x").rsplit("x-", 1)[1])


def test_archives_lie_where_spark_resolves_them(spark):
    """A folder without a scheme is resolved on the session's default file system, and each archive is read by a task of its own."""
    import os.path
    folder = scratch_path(spark, "plain").removeprefix("file:")
    assert warc.qualified(spark, folder) == "file:" + folder
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "hdfs://nowhere:1")
    try:
        with pytest.raises(Exception, match="nowhere"):
            warc.qualified(spark, "/x") and warc.read_record(warc.qualified(spark, "/x") + "/a", 0, 1)
    finally:
        conf.set("fs.defaultFS", before)
    pages = spark.createDataFrame([(i, "u", "p" * (i + 1) * 500) for i in range(40)], "page_id long, url string, html string").repartition(3)
    manifest = warc.write_archives(warc.plan_records(pages), folder, archive_bytes=300)
    n = manifest.count()
    back = warc.read_archives(manifest)
    assert n > 10 and back.rdd.getNumPartitions() == n and back.count() == 40 and os.path.isdir(folder)
    with pytest.raises(ValueError):
        warc._open("relative/path")


def test_counts_by_one_sort_add_up():
    """Entries that share a hash's leading bits may come out in parts; their counts add up to those of the whole."""
    base = np.uint64(0xABCDEF0123400000)
    hashes = np.array([base + np.uint64(k % 3) for k in range(50)] + [7, 7, 0], np.uint64)
    checks = np.array([k % 2 for k in range(50)] + [1, 2, 0], np.uint32)
    weights = np.arange(1, 54)
    for counts in (None, weights):
        want, got = collections.Counter(), collections.Counter()
        for h, c, n in zip(hashes.tolist(), checks.tolist(), np.ones(53, int) if counts is None else counts):
            want[h, c] += int(n)
        at, n = wordmap._distinct(hashes, checks, counts)
        for i, k in zip(at, n):
            got[int(hashes[i]), int(checks[i])] += int(k)
        assert got == want
    assert [len(x) for x in wordmap._distinct(hashes[:0], checks[:0])] == [0, 0]


@pytest.mark.parametrize("texts", [[""], ["", " \n"], ["Ab.c", "D'e,f"], ["É.A b.C", "<|x|>.Y", "z"], ["a", "b", ".", "."], ["x.." * 50, "1a2.b"]])
def test_words_cover_the_text_in_order(texts):
    """Words are neither empty nor across texts; together they are the text without white space, lower-cased where a word is ASCII alone."""
    data, starts, ends, first = tokenfile.word_cut([t.encode() for t in texts])
    assert (ends > starts).all() and (starts[1:] >= ends[:-1]).all()
    for i, text in enumerate(texts):
        words = [data[a:b].tobytes().decode() for a, b in zip(starts[first[i]:first[i + 1]], ends[first[i]:first[i + 1]])]
        want = [w if any(ord(c) > 127 or c in "<|" for c in w) else w.lower() for w in text.split()]
        assert "".join(words) == "".join(want)


def test_dictionary_arrays_come_back(spark):
    """Both ways to a shared file: where it lies, and a copy that Spark hands out."""
    arrays = [np.arange(5, dtype=np.uint64), np.zeros(0, np.int32), np.arange(3, dtype="<u2")]
    name, layout = wordmap.share(spark, arrays)
    spark.sparkContext.addFile(name)
    for where in (name, name.rsplit("/", 1)[1]):
        assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, wordmap.mapped((where, layout))))


@pytest.mark.parametrize("limit", [wordmap.DICTIONARY_WORDS, 2])
def test_texts_need_not_come_back_from_the_encoding(spark, limit):
    """The same ids without the text column, whether all words are in the dictionary or some are joined."""
    docs = spark.createDataFrame([(1, "a bb a ccc", 7), (2, None, 8), (3, "", 9), (4, "ccc dd dd", None)], "doc_id long, text string, tie long")
    words = spark.createDataFrame([("a", 2, [1]), ("bb", 1, [2, 2]), ("ccc", 2, [3]), ("dd", 2, [4, 5])], "chunk string, n long, ids array<int>")
    whole, bare = (wordmap.encode(docs, "text", "ids", words, tokenfile.word_cut, False, limit, keep_text=k) for k in (True, False))
    assert bare.columns == ["doc_id", "tie", "ids"]
    want = sorted((r.doc_id, r.tie or 0, list(r.ids)) for r in whole.collect())
    assert sorted((r.doc_id, r.tie or 0, list(r.ids)) for r in bare.collect()) == want
    assert [x[2] for x in want] == [[1, 2, 2, 1, 3], [], [], [3, 4, 5, 4, 5]]


def test_words_between_numerals_have_the_ids_that_they_have_alone(spark):
    """Words join into one text between numerals that none of them holds, beside symbols, marks and other numerals too."""
    from tokenizers import Tokenizer
    vocabulary = public_tokenizers.path(tokenfile.VOCABULARY)
    coder = Tokenizer.from_file(vocabulary)
    assert [c for c, _ in tokenfile._separators(coder)] == list("²½0123456789")
    odd = ["a", "it's", "'s", "...", "<b>", "a|b", "12", "²", "x²", "½", "́a", "̸", "≠", "Été", "ΣΣ", "<|end", "oftext|>",
           "a b", "　", "中文", "\U0001f600", "٠", "한", "!?", "don't", ""]
    for extra in ([], ["<|endoftext|>"], list("0123456789")):
        words = [w for w in odd if extra or not any(c.isdigit() for c in w)] + extra
        got = tokenfile.encode_words(spark.createDataFrame([(w, 1) for w in words], "chunk string, n long").coalesce(1), vocabulary).collect()
        assert [(r.chunk, r.ids) for r in got] == [(w, coder.encode(w, add_special_tokens=False).ids) for w in words]


def test_frequent_words_stand_first_among_equal_leading_bits(spark):
    """The dictionary is in order of the hashes' leading bits, then of falling counts, so a text's words are mostly found at the first look."""
    rows = [(f"word{i}", 1 << i % 7, [i]) for i in range(900)]
    hashes, checks, to, flat, missing = wordmap.dictionary(spark.createDataFrame(rows, "chunk string, n long, ids array<int>"), 1000, np.dtype("<u2"))
    lead = hashes >> np.uint64(64 - wordmap._lead_bits(len(hashes)))
    often = np.array([1 << int(i) % 7 for i in flat[to[:-1]]])
    assert missing == 0 and (np.diff(lead.astype(np.int64)) >= 0).all()
    assert (often[1:] <= often[:-1])[lead[1:] == lead[:-1]].all() and (lead[1:] == lead[:-1]).any()
    index = wordmap._index(hashes)
    assert wordmap._find(hashes, checks, hashes, checks, index).tolist() == list(range(900))
    assert (wordmap._find(hashes ^ np.uint64(1), checks, hashes, checks, index) == -1).all()
    assert (wordmap._find(hashes, checks ^ np.uint32(2), hashes, checks, index) == -1).all()
    none = np.zeros(0, np.uint64)
    assert wordmap._find(hashes[:2], checks[:2], none, none.astype(np.uint32), wordmap._index(none)).tolist() == [-1, -1]


def test_texts_go_to_python_in_small_batches(spark):
    """Spark holds a batch of texts three times; a session's own setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.createDataFrame([("a b a",)], "text string")
    try:
        for own, then in (("10000", "2000"), ("300", "300")):
            spark.conf.set(key, own)
            assert {r.chunk: r.n for r in wordmap.count(docs, "text", tokenfile.word_cut).collect()} == {"a": 2, "b": 1}
            assert spark.conf.get(key) == then
    finally:
        spark.conf.unset(key)


def test_gathered_rows_do_not_pass_the_jvm_of_the_driver(spark, monkeypatch):
    """Training samples and the dictionary come from files; only the languages' bucket counts (two flat columns) come by toArrow."""
    from intervalflow.llm import langid, quality
    seen, frame = [], type(spark.range(0))
    plain = frame.toArrow
    monkeypatch.setattr(frame, "toArrow", lambda self: seen.append(self.dtypes) or plain(self))
    texts = spark.createDataFrame([(i, "good words stand here " * 9 if i % 2 else "der Hund und die Katze " * 9, "en" if i % 2 else "de") for i in range(80)],
                                  "doc_id long, text string, lang string").repartition(4)
    labels = texts.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    scores = {r.doc_id: r.score for r in quality.quality_scores(texts, labels).collect()}
    assert min(s for i, s in scores.items() if i % 2) > max(s for i, s in scores.items() if not i % 2)
    words = spark.createDataFrame([("ab", 3, [1, 2]), ("c", 9, [3])], "chunk string, n long, ids array<int>")
    assert sorted(wordmap.dictionary(words, 9, np.dtype("<u2"))[3].tolist()) == [1, 2, 3]
    assert wordmap.dictionary(words.limit(0), 9, np.dtype("<u2"))[4] == 0 and not seen
    assert langid.train(texts)[0] == ["de", "en"]
    assert [kind for table in seen for _, kind in table] == ["bigint", "bigint"]


@pytest.mark.parametrize("known", [True, False])
def test_collected_rows_come_in_the_order_of_the_partitions(spark, monkeypatch, known):
    from intervalflow.llm import storage
    if not known:
        monkeypatch.setattr(storage, "open_path", lambda path: storage.pafs.FileSystem.from_uri("strange://host/folder"))
    rows = [(i, None if i % 7 == 0 else f"t{i}", [i, i + 1], bytes([i])) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, t string, v array<int>, b binary").repartitionByRange(5, "id").sortWithinPartitions("id")
    got = storage.collected(df, "few")
    assert [tuple(r.values()) for r in got.to_pylist()] == rows if known else sorted(tuple(r.values()) for r in got.to_pylist()) == rows
    assert storage.collected(df.limit(0), "few").schema.names == ["id", "t", "v", "b"]
    folder = storage.qualified(spark, scratch_path(spark, "x")).rsplit("/", 1)[0].removeprefix("file:")
    assert not [f for f in os.listdir(folder) if f.startswith("few-")]
