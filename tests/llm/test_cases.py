"""Nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns for every operator."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from gazetta.llm import common, fingerprints, language, lines, packing, pieces, simhash, token_files, topk, toxicity, urls

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, score string, kind string, part string, h1 string, fp string, id string, key string, nth string"
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
LINE = "a line that is long enough to be looked at, and shared"
TEXTS = [
    (1, "The cat sat on the mat.\nIt was fine."),
    (2, None),
    (3, ""),
    (4, LONG),
    (5, "The cat sat on the mat.\nIt was fine."),
    (5, "The cat sat on the mat.\nIt was fine."),
    (5, "Other words under the same id."),
    (None, "No id here, but words."),
    (6, "   \n\t  \n"),
    (7, "12345 !!! ---"),
    (8, "ǅungla ﬁne İstanbul 中文 😀 a\u0301"),
    *[(10 + i, f"own line number {i}\n  {LINE.upper() if i % 2 else LINE} \nend {i}") for i in range(7)],
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i else None, None, len(t) if t else None, *["x"] * 9) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, int(i == 4)) for i in range(1, 17)] + [(None, 1, 1), (3, None, None), (1, 1, 0)], "doc_id long, quality int, toxic int")


def library_ids(path, text, end=(1,)):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids, *end]


def test_packing(spark, docs, none):
    got = [r.asDict() for r in packing.pack(docs, BYTES).collect()]
    want = sorted(((i is None, i or 0, len(library_ids(BYTES, t))) for i, t in TEXTS))
    total = {}
    for r in got:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    sums = {}
    for _, i, n in want:
        sums[i] = sums.get(i, 0) + n
    assert {k or 0: v for k, v in total.items()} == sums
    for sequence in {r["sequence_id"] for r in got}:
        own = sorted((r for r in got if r["sequence_id"] == sequence), key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))]
        assert sum(r["length"] for r in own) <= 2048
    whole = packing.pack(docs.where("doc_id IN (1, 4)"), BYTES)
    ids = {r["sequence_id"]: r for r in packing.packed_ids(docs.where("doc_id IN (1, 4)"), whole, BYTES).collect()}
    for r in whole.collect():
        held = ids[r["sequence_id"]]["ids"][r["offset"] : r["offset"] + r["length"]]
        assert zlib.crc32(np.array(held, "<u4").tobytes()) == r["ids_crc32"]
    assert packing.pack(none, BYTES).count() == 0


@pytest.mark.parametrize("n", [1, 7, 300, 5000])
def test_packing_layout_has_a_place_for_every_remainder(n):
    rng = random.Random(n)
    counts = {}
    for _ in range(n):
        size = rng.choice([rng.randint(1, 128), 100])  # one length holds half of all
        counts[size] = counts.get(size, 0) + 1
    layout = packing.lay_out(counts)
    filled = {}
    for size, number in counts.items():
        for rank in range(number):
            at = int(np.searchsorted(layout.key, (size << 40) + rank, "right")) - 1
            assert int(layout.key[at]) >> 40 == size
            rows = layout.rows[layout.first_row[at] : layout.first_row[at] + layout.n_rows[at]].tolist()
            assert sorted(u for k in rows for u in range(layout.unit_from[k], layout.unit_from[k] + layout.unit_len[k])) == list(range(size))
            for k in rows:
                slot = int(layout.slot[k] + rank - layout.rank[k])
                place = (int(layout.seq[k] + slot // layout.per_seq[k]), int(layout.order[k] + slot % layout.per_seq[k]))
                assert place not in filled
                filled[place] = int(layout.unit_len[k])
    used = {}
    for (sequence, _), units in filled.items():
        used[sequence] = used.get(sequence, 0) + units
    assert max(used.values()) <= packing.UNITS
    needed = sum(k * v for k, v in counts.items()) / packing.UNITS
    assert len(used) <= needed * 1.001 + 20 and len(layout.seq) < 2000


def test_column_generation_meets_a_known_optimum():
    demand = np.zeros(100)
    demand[29], demand[69] = 90, 10
    patterns, cuts = packing.column_generation(demand, cut_cost=10.0, gap=1e-6)
    # cuts are too dear: ten sequences of 70 and 30, the other eighty of 30 by threes
    assert not cuts and sum(n for n, _ in patterns) == pytest.approx(10 + 80 / 3, rel=1e-4)
    patterns, cuts = packing.column_generation(demand, cut_cost=1e-6, gap=1e-6)
    assert sum(n for n, _ in patterns) == pytest.approx((90 * 30 + 10 * 70) / 100, rel=1e-4)


def test_checksums_of_parts():
    data = np.random.default_rng(3).integers(0, 50_000, 2048).astype("<u4").tobytes()
    first, last = np.array([0, 1, 16, 2000]), np.array([2048, 2, 800, 2048])
    before = np.array([zlib.crc32(data[: 4 * a]) for a in first])
    through = np.array([zlib.crc32(data[: 4 * b]) for b in last])
    want = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(first, last, strict=True)]
    assert packing.part_crc32(before, through, last - first, 2048).tolist() == want


def test_token_files(spark, docs, none, tmp_path):
    path = token_files.write_token_files(docs, str(tmp_path / "ids"), WORDS, index_rows=1000)
    rows = [r.asDict() for r in token_files.read_token_files(spark, path).orderBy("start").collect()]
    order = sorted(((i is not None, i or 0, t or "") for i, t in TEXTS))
    at = 0
    for r, (named, i, t) in zip(rows, order, strict=True):
        ids = library_ids(WORDS, t)
        assert (r["doc_id"], r["start"], r["ids"]) == (i if named else None, at, ids)
        at += len(ids)
    some = token_files.read_token_files(spark, path, [4, 12])
    assert sorted(r["doc_id"] for r in some.collect()) == [4, 12]
    assert "PushedFilters: [In(doc_id" in some._jdf.queryExecution().executedPlan().toString().replace("*", "")
    import pyarrow.orc

    file = next(tmp_path.glob("ids/part-*.orc"))
    assert pyarrow.orc.ORCFile(str(file)).nstripes >= 1
    empty = token_files.write_token_files(none, str(tmp_path / "none"), WORDS)
    assert token_files.read_token_files(spark, empty).count() == 0


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_equals_the_library_on_odd_texts(path):
    from tokenizers import Tokenizer

    from gazetta.llm.tokens import Encoder

    rng = random.Random(5)
    parts = ["a", "B", "é", "e\u0301", " ", "  ", "\n", "\t", "\u00a0", ".", "'s", "'", "1", "²", "3", "_", "-", "中", "ß", "İ", "Σ", "\x1c", "!?", "word", "ing", "\u200b", "ſ", "ª", "'ll", " \n ", "<|endoftext|>", "\u0958"]
    found = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    own, library = Encoder(path), Tokenizer.from_file(path)
    for text, ids in zip(found, own.encode(found, 1), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == [*library.encode(text, add_special_tokens=False).ids, 1], text


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_knows_new_words_of_letters_without_encoding_texts(path, monkeypatch):
    """New words of letters go to the model itself; every Latin-1 letter, case and place in a line gives the library's ids."""
    from tokenizers import Tokenizer

    from gazetta.llm.tokens import Encoder

    rng, library = random.Random(6), Tokenizer.from_file(path)
    letters = [*map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)])]
    words = [*letters, *("".join(rng.choices(letters, k=rng.randint(2, 12))) for _ in range(2000))]
    found = ["".join(w + rng.choice([" ", " ", "\n", ". ", "&&& ", "###\n"]) for w in rng.choices(words, k=30)) + "end" for _ in range(300)]
    own, texts, whole = Encoder(path), [], Encoder._whole
    monkeypatch.setattr(Encoder, "_whole", lambda self, batch: texts.extend(batch) or whole(self, batch))
    for text, ids in zip(found, own.encode(found), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    inner = {w for text in found for w in text.replace("\n", " ").split()[1:]}
    assert len(own.place) > 1000 and len(texts) < 320 < len(inner)  # heads of texts and runs of signs
    own._forget()
    monkeypatch.setattr(own, "tokenizer", None)  # no text is put together for the rest
    own._learn([*dict.fromkeys(words), *("\n" + w for w in dict.fromkeys(words))])
    assert own.place.keys() == {*words, *("\n" + w for w in words)}


def test_toxicity(spark, docs, none, labels):
    got = toxicity.toxicity(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (2, 3, 6)}
    assert len(empty) == 1
    assert [r["score"] for r in toxicity.toxicity(docs, labels.where("toxic = 0")).collect()] == [0.0] * len(TEXTS)
    assert toxicity.toxicity(none, labels).count() == 0
    assert toxicity.drop_toxic(docs, labels).columns == docs.columns
    assert toxicity.drop_toxic(docs, labels.where("toxic = 0")).count() == len(TEXTS)


def test_toxicity_model_is_a_distribution_and_knows_rare_expressions():
    words = ["fine", "find", "fish", "good"] * 5 + ["zork"]
    grams, owner = toxicity._spelled(words)
    told = np.array([words[i].startswith("zork") for i in owner], np.int64)
    toxic, ordinary = told * 300, (1 - told) * 300
    model = toxicity.Model(grams, ordinary, toxic, 20)
    zork, fine, new = model.ratios(["zorkel", "fine", "quux"])
    assert zork > 1 and fine < 0 and zork > new
    # the next character's probabilities sum to at most 1 in a known context
    start = np.array([[ord("\x02")] * 3 + [ord("f"), ord(c)] for c in "abcdefghijklmnopqrstuvwxyz"])
    gram, context = model._slots(start, 0, 5), model._slots(start, 0, 4)
    assert (model.count[0][gram] / model.total[0][context]).sum() == pytest.approx(1, abs=1e-5)


def test_toxicity_counts_no_gram_for_another(spark):
    """All ratios by DataFrames equal the model in memory with far more slots than 5-grams; every 5-gram has its own counts."""
    rng = random.Random(11)
    words = sorted({"".join(rng.choice("abcdefgàé中") for _ in range(rng.randint(1, 9))) for _ in range(300)})
    known = words[: len(words) // 2]
    grams, owner = toxicity._spelled(words)
    names = ["".join(map(chr, g)) for g in grams.tolist()]
    table = {}
    for name, i in zip(names, owner.tolist(), strict=True):
        n = (0, 0) if words[i] not in known else (1 + i % 5, i % 3)
        a, b = table.get(name, (0, 0))
        table[name] = (a + n[0], b + n[1])
    counted = np.array([[ord(c) for c in g] for g in table], np.uint32)
    ordinary, toxic = (np.array([v[k] for v in table.values()], np.int64) for k in (0, 1))
    model = toxicity.Model(counted, ordinary, toxic, 24)
    rows = spark.createDataFrame([(g, *v) for g, v in table.items()], "gram string, ordinary long, toxic long")
    got = {r["gram"]: r["ratio"] for r in toxicity._gram_ratios(rows).collect()}
    assert set(got) == set(table)
    chunk = toxicity._Ratios(list(got), list(got.values()))
    assert np.allclose(chunk.ratios(words), model.ratios(words), atol=1e-4)
    with pytest.raises(ValueError):
        chunk.ratios(["unseen"])


def test_toxicity_keeps_more_grams_than_slots(spark):
    """The table of counts grows with the corpus: every 5-gram of every text is in it, with its own counts."""
    docs = spark.createDataFrame([(i, f"w{chr(0x4E00 + i)}{chr(0x5E00 + 7 * i % 5000)}", 1) for i in range(1, 400)], "doc_id long, text string, part int")
    known = spark.createDataFrame([(i, i % 2) for i in range(1, 400)], "doc_id long, toxic int")
    rows = toxicity._gram_rows(docs, known, 5).groupBy("gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect()
    got = {r["gram"]: (r["n0"], r["n1"]) for r in rows}
    want = {}
    for i in range(1, 400):
        grams, _ = toxicity._spelled(toxicity.words_of(f"w{chr(0x4E00 + i)}{chr(0x5E00 + 7 * i % 5000)}"))
        for g in grams.tolist():
            name = "".join(map(chr, g))
            a, b = want.get(name, (0, 0))
            want[name] = (a + (i % 2 == 0), b + (i % 2 == 1))
    assert got == want


def test_toxicity_features_of_bags_equal_those_of_the_words_in_order():
    """Every occurrence counts; a bag gives a text's distinct words and their numbers back."""

    class Known:
        def __init__(self):
            self.known = {}

        def ratios(self, words):
            return np.array([(sum(map(ord, w)) % 97) / 10 - 4 for w in words])

    rng = random.Random(8)
    words = ["aa", "b", "Çé", "中文", "zork", "ß", "word", "\ud800x"]
    found = ["", "1 2 _", "b", "b b", "B b b b", *[" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(60)]]
    bags = [toxicity._unbagged(toxicity._bag(t)) for t in found]
    assert [dict(zip(*b, strict=True)) for b in bags] == [dict(Counter(toxicity.words_of(t))) for t in found]
    for text, row in zip(found, toxicity._features(bags, Known(), 0.5), strict=True):
        values = sorted(Known().ratios(toxicity.words_of(text)) - 0.5, reverse=True)
        n = len(values)
        want = [sum(values) / max(n, 1), sum(values[:3]) / max(min(n, 3), 1)]
        want += [np.log((sum(max(v - 2, 0) for v in values) + 0.1) / (n + 20)), np.log((sum(v > 3 for v in values) + 0.05) / (n + 20))]
        assert np.allclose(row, want)


def test_toxicity_of_short_repeated_and_mostly_toxic_texts(spark):
    rng = random.Random(5)
    plain = ["table", "window", "garden", "river", "music", "paper", "letter", "winter", "summer", "bread"]
    slurs = ["zorkhead", "grublik", "vexnard"]
    rows, marks = [], []
    for i in range(1, 1201):
        toxic = i % 4 == 0
        words = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        for _ in range(rng.randint(1, 4) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(slurs)
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    cases = {
        10001: " ".join(slurs * 17), 10002: "zorkhead " * 50, 10003: "zorkhead", 10004: "zorkhead grublik", 10005: " ".join(slurs * 10 + plain * 2),
        10011: " ".join(plain * 5), 10012: "garden " * 50, 10013: "garden", 10014: "", 10015: "river music",
    }
    docs = spark.createDataFrame([*rows, *cases.items()], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, spark.createDataFrame(marks, "doc_id long, toxic int")).collect()}
    assert {i: got[i] >= 0.7 for i in cases} == {i: i < 10010 for i in cases}


def test_top_k(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-2, 2) for _ in range(6)], "x") for i in range(0, 400)]
    rows += [(i, [1.0] * 6, "x") for i in range(400, 520)]  # copies: ties
    rows += [(600, None, "x"), (700, [float("nan")] * 6, "x"), (800, [None] * 6, "x"), (900, [float("inf")] * 6, "x"), (None, [1.0] * 6, "x"), (521, [], "x"), (1000, [-1.0] * 6, "x")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, v string")
    for shard_rows, block_rows in ((8192, 512), (50, 2)):
        got = topk.top_k(vectors, F.col("vec_id") % 100 == 0, 10, shard_rows=shard_rows, block_rows=block_rows).collect()
        usable = {i: [int(np.floor(1024 * float(np.float32(x)))) for x in v] for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
        want = set()
        for q, own in usable.items():
            if q % 100 == 0:
                scores = sorted((-sum(a * b for a, b in zip(own, v, strict=False)), i) for i, v in usable.items() if i != q)
                want |= {(q, n, i, -s) for n, (s, i) in enumerate(scores[:10], 1)}
        assert {tuple(r) for r in got} == want
    assert topk.top_k(vectors.where("vec_id < 3"), F.col("vec_id") == 0).count() == 2
    assert topk.top_k(vectors.limit(0), F.col("vec_id") == 0).count() == 0


def test_fingerprints(spark, docs, none):
    got = fingerprints.compare_versions(docs).collect()
    assert len(got) == len(TEXTS)
    order = sorted(((i is not None, i or 0, t or "") for i, t in TEXTS))
    want = {}
    for (named, i, t), following in zip(order, order[1:] + order[:1], strict=True):
        changed = fingerprints.edited(t, following[2])
        want.setdefault((i if named else None, len(t)), set()).add(hashlib.sha256(changed.encode()).hexdigest())
    assert all(r["edited_sha256"] in want[r["doc_id"], r["n_chars"]] for r in got)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    alone = fingerprints.compare_versions(docs.where("doc_id = 1")).first()
    assert alone["near_next"] == 1
    assert fingerprints.compare_versions(none).count() == 0


def test_sketches_recover_differences_of_any_size():
    rng = np.random.default_rng(1)
    first, second, want = [], [], []
    for n in (0, 1, 3, 10, 100, 3000):
        common, a, b = (rng.integers(0, 2**63, k).astype(np.uint64) for k in (500, n, n // 2))
        first.append(np.concatenate([common, a]))
        second.append(np.concatenate([common, b]))
        want.append((set(a.tolist()), set(b.tolist())))
    got = fingerprints.differences(first, second)
    assert [(set(a.tolist()), set(b.tolist())) for a, b in got] == want


def test_repeated_paragraphs_count():
    one, two = fingerprints.digests("Same. Same."), fingerprints.digests("Same.")
    assert len(set(one.tolist())) == 2 and len(two) == 1


def near(a, b):
    return (a ^ b).bit_count() <= 4


def test_simhash(spark, docs, none):
    rows = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in simhash.fingerprint_rows(docs).collect()}
    assert rows[2, "0" * 16] == rows[3, "0" * 16] == rows[6, "0" * 16] == 2
    assert len({k for k in rows if k[0] == 5}) == 2
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    texts = [r["text"] for r in kept.collect()]
    assert texts.count("The cat sat on the mat.\nIt was fine.") == 1
    assert "No id here, but words." in texts
    assert simhash.fingerprint_rows(none).count() == 0 and simhash.drop_near_copies(none).count() == 0


def test_links_join_whatever_is_near(spark):
    rng = random.Random(7)
    centres = [rng.getrandbits(64) for _ in range(40)]
    fps = set(centres)
    for c in centres:
        step = c
        for _ in range(12):  # chains: neighbours 4 bits apart
            for bit in rng.sample(range(64), 4):
                step ^= 1 << bit
            fps.add(step)
    crowd = rng.getrandbits(64)
    fps |= {crowd ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)}  # one large group of near copies
    fps = sorted(fps)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed + signed[:50]], "fp long")
    links = simhash.links(df)
    found = [(r["a"] % 2**64, r["b"] % 2**64) for r in links.collect()]
    assert all(near(a, b) for a, b in found)
    assert len(found) < 40 * len(fps)
    root = {f: f for f in fps}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if near(a, b):
                root[find(a)] = find(b)
    groups = {}
    for f in fps:
        groups.setdefault(find(f), set()).add(f)
    got = {}
    for r in simhash.components(links).collect():
        got.setdefault(r["root"], set()).add(r["node"] % 2**64)
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_segments_leave_one_with_at_most_one_bit():
    for distance in range(1, 8):
        parts = simhash.segments(distance)
        assert sum(n for _, n in parts) == 64 and 2 * len(parts) > distance


def test_pieces(spark, docs, none):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = pieces.encode_pieces(docs, PIECES).collect()
    by_ids = {}
    for i, t in TEXTS:
        by_ids.setdefault(i, []).append(t or "")
    for r in rows:
        text = next(t for t in by_ids[r["doc_id"]] if library.encode(t, add_bos=True, add_eos=True) == r["ids"])
        data = text.encode()
        spans = list(zip(r["begins"], r["ends"], strict=True))[1:-1]
        assert b"".join(data[a:b] for a, b in spans) == data
        for piece, (a, b) in zip(r["ids"][1:-1], spans, strict=True):
            if not library.is_byte(piece):
                assert data[a:b].decode().replace(" ", "▁") in (library.id_to_piece(piece), library.id_to_piece(piece)[1:])
    decoded = pieces.decode_pieces(pieces.encode_pieces(docs, PIECES), PIECES)
    assert sorted(r["text"] for r in decoded.collect()) == sorted(t or "" for _, t in TEXTS)
    assert pieces.piece_digests(none, PIECES).count() == 0


def test_normaliser_equals_the_library_with_a_character_map():
    import sentencepiece

    rng = random.Random(5)
    parts = ["a", "B", "é", "e\u0301", " ", "  ", "\n", "\t", "▁", "1", "²", "中", "Å", "ﬁ", "ſ", "\u3000", "\u200b", "😀", "①", "ｶﾞ", "\r", "\u00a0", "\u0958", "가", "ẛ̣"]
    for rule, extra in (("nmt_nfkc", True), ("nfkc_cf", False), ("identity", True)):
        library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=extra)
        own = pieces.Normalizer(library.serialized_model_proto())
        for _ in range(3000):
            text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
            data, places = own(text)
            assert data.decode() == library.normalize(text), text
            assert len(places) == len(data) + 1 and (np.diff(places) >= 0).all()
    data, places = pieces.Normalizer(
        sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=False, escape_whitespaces=False, remove_extra_whitespaces=False).serialized_model_proto()
    )("xﬁ①")
    assert (data.decode(), places.tolist()) == ("xfi1", [0, 1, 1, 4, 7])


@pytest.mark.parametrize(("rule", "extra", "byte_pieces"), [("identity", False, True), ("nmt_nfkc", True, True), ("nfkc_cf", False, True), ("nmt_nfkc", True, False)])
def test_ids_of_the_own_normalised_text_equal_the_library(tmp_path, rule, extra, byte_pieces):
    import sentencepiece

    maps = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=extra)
    with open(PIECES, "rb") as file:
        fields = [(n, v) for n, v in pieces._fields(file.read()) if n in (1, 2)]
    if not byte_pieces:  # what no piece covers is unknown: byte pieces become unused, the trainer's setting (35) goes off
        fields = [(n, pieces._message([(m, 5 if m == 3 and x == 6 else 0 if (n, m) == (2, 35) else x) for m, x in held])) for n, held in ((n, known(v)) for n, v in fields)]
    fields += [(n, v) for n, v in pieces._fields(maps.serialized_model_proto()) if n == 3]
    path = tmp_path / "own.model"
    path.write_bytes(pieces._message(fields))
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    own = pieces.PieceEncoder(str(path))
    rng = random.Random(11)
    parts = ["the ", "a", "B", "é", "e\u0301", " ", "  ", "\n", "▁", "12", "²", "中", "Å", "ﬁ", "\u3000", "\u200b", "😀", "①", "ｶﾞ", "\u00a0", "가", "<s>", "\0"]
    many = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 20))) for _ in range(2000)] + ["", " ", "▁", "x" + " ▁" * 50_000, " ▁" * 50_000 + "x"]
    ids, spans = own.encode(many)
    assert ids == library.encode(many, add_bos=True, add_eos=True)
    for text, own_ids, (begins, ends) in zip(many, ids, spans, strict=True):
        assert len(begins) == len(ends) == len(own_ids)
        assert (np.diff(begins[:-1]) >= 0).all() and (begins <= ends).all() and ends[-1] == len(text.encode())
    assert byte_pieces or any(library.unk_id() in x for x in ids)


def known(message):
    """Fields of a message with numbers and bytes; scores of four bytes are left out."""
    return [(m, x) for m, x in pieces._fields(message) if isinstance(x, int) or m == 1]


def test_language(spark, docs, none):
    rows = language.identify(docs).collect()
    assert len(rows) == len(TEXTS)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert all(found[i] == ("und", 0.0) for i in (2, 3, 6, 7))
    assert found[4] == ("en", 1.0)
    assert language.identify(none).count() == 0
    assert {r["lang_pred"] for r in language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, t in TEXTS} - {2, 3, 6, 7}


def test_a_text_without_letters_is_empty():
    assert [language.normalised(t) for t in ("", " 12 !?", "² ½", "A²", "中 1 É")] == [b"", b"", b"", "a²".encode(), "中 é".encode()]


def test_parser_counts_the_phrases_of_a_greedy_parse():
    rng = random.Random(2)
    samples = {x: "".join(rng.choice("ab cd") for _ in range(300)).encode() for x in ("one", "two")}
    parser = language.Parser(samples)
    found = ["".join(rng.choice("ab cde") for _ in range(n)).encode() for n in (1, 5, 60, 511, 512, 513, 2000)]
    got = parser.phrases(found)
    for i, data in enumerate(found):
        for j, name in enumerate(parser.languages):
            count = 0
            for block in range(0, len(data), language.BLOCK):
                count, phrase = count + 1, b""
                for byte in data[block : block + language.BLOCK]:
                    char = bytes([byte])
                    if phrase + char in samples[name]:
                        phrase += char
                    else:  # a byte that the sample lacks ends a phrase and is part of none
                        count, phrase = count + 1, char if char in samples[name] else b""
            assert got[i, j] == count


def test_lines(spark, docs, none):
    got = {(r["doc_id"], r["kept_sha256"]): (r["n_lines"], r["n_dropped"]) for r in lines.line_digests(docs).collect()}
    for i, t in TEXTS:
        kept = (t or "").split("\n")
        n = len(kept)
        if i and 10 <= i < 16:
            kept = [x for x in kept if LINE not in x.lower()]
        assert got[i, hashlib.sha256("\n".join(kept).encode()).hexdigest()] == (n, n - len(kept))
    cleaned = lines.dedup_lines(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == len(TEXTS)
    row = {r["doc_id"]: r for r in cleaned.collect()}
    assert row[10]["text"] == "own line number 0\nend 0" and row[10]["n_chars"] == len(row[10]["text"]) and row[2]["text"] is None
    assert lines.line_digests(none).count() == 0


def test_texts_go_through_line_dedup_once_and_unsorted(spark, docs):
    """A row's text is shuffled inside its row only and meets its bitmap without a sort; what a worker kept before is let go."""
    bitmaps = spark.createDataFrame([], "doc_id long, text_key long, bitmap binary")
    plan = lines.with_kept_lines(docs, bitmaps)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    shuffled = next(x for x in plan.splitlines() if "Project" in x and "struct(" in x)
    assert shuffled.count("text#") == 2  # in the row, and for its hash
    common.resident("kept", lambda: [0])
    common.release()
    assert not common._resident
    odd = docs.withColumnsRenamed({"text": "Text"}).withColumn("a`b c", F.lit(1))
    assert lines.dedup_lines(odd).columns == odd.columns
    texts = {r["doc_id"]: (r["Text"], r["a`b c"]) for r in lines.dedup_lines(odd).collect()}
    assert texts[10] == ("own line number 0\nend 0", 1)


def test_a_line_that_most_documents_share(spark):
    rows = [(i, f"{LINE}\n{'rare ' * 10}{i % 300}\n{LINE}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = {r["doc_id"]: r["n_dropped"] for r in lines.line_digests(docs).collect()}
    for i in range(2000):
        assert found[i] == (2 if i != 1999 else 0) + (1 if i + 300 < 2000 else 0)


def test_bitmaps_round_trip(spark, docs):
    for r in lines.keep_bitmaps(docs).collect():
        assert lines.dropped(r["bitmap"]).tolist() == [1]
    assert lines.dropped(None).tolist() == []


def test_urls(spark):
    rules = [urls.Rule("com", "/", "allow"), urls.Rule("example.com", "/a*b/", "block"), urls.Rule("x.org", "", "block"), urls.Rule("", "/ads/", "block"), urls.Rule("com", "/", "allow")]
    cases = {
        "http://WWW.Example.com/axxb/c?q": ("www.example.com", "/axxb/c", "example.com/a*b/", "block"),
        "http://example.com": ("example.com", "", None, "allow"),
        "http://notx.org/": ("notx.org", "/", None, "allow"),
        "http://a.x.org#f/": ("a.x.org", "", "x.org", "block"),
        "ftp://x.org/y://z/": ("x.org", "/y://z/", "x.org", "block"),
        "no scheme": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "http://é.com/É" + "x" * 20_000: ("é.com", "/É" + "x" * 20_000, "com/", "allow"),
    }
    rows = [(i, u, "x", "x") for i, u in enumerate([*cases, *cases])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    got = urls.judge_urls(pages, rules).collect()
    assert len(got) == 2 * len(cases)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == cases[rows[r["page_id"]][1]]
    assert urls.judge_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in urls.judge_urls(pages, [], default="block").collect()} == {"block"}


def _tongue(rng, n):
    letters = [chr(0x0400 + 16 * (n % 6) + rng.randrange(16)) if n % 3 else chr(97 + rng.randrange(26)) for _ in range(7)]
    return ["".join(rng.choice(letters) for _ in range(rng.randint(3, 7))) for _ in range(12)]


def test_every_language_is_learnt(spark):
    """More than a hundred languages, also those whose first texts have no letter."""
    rng = random.Random(9)
    words = {f"l{n:03}": _tongue(rng, n) for n in range(110)}
    rows, at = [], 0
    for lang, own in words.items():
        for _ in range(4):
            rows.append((at, lang, " ".join(rng.choice(own) for _ in range(40))))
            at += 1
    rare = _tongue(rng, 2)
    rows += [(at + i, "rare", f"{i} 12 !? " * 40) for i in range(400)]
    rows += [(at + 400 + i, "rare", "0 " * 3000 + " ".join(rng.choice(rare) for _ in range(80))) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    samples = language.learn_samples(docs, F.lit(True))
    assert {r["lang"] for r in samples.collect()} == {*words, "rare"}
    some = docs.where("lang < 'l012'")
    few = language.learn_samples(some, F.lit(True))
    whole, parts = ({(r["row"]["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in language.identify_rows(some, few, n).collect()} for n in (12, 5))
    assert whole == parts
    test = docs.where("lang IN ('l000', 'l104', 'l109', 'rare')")
    found = [(r["row"]["lang"], r["lang_pred"]) for r in language.identify_rows(test, samples, 60).collect()]
    assert len(found) == 416 and all(p == lang for lang, p in found if p != "und") and sum(p == "und" for _, p in found) == 400
