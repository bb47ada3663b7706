"""Conversation repair, collocations and sentence pieces against plain
versions, and their defined results on odd tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import collocations, conversation_repair, double_array, sentence_pieces
from tidemark.llm.queries import QUERIES

WHITE = " \t\n\x0b\x0c\r"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
LONG = "One two, three four. " * 20_000


# --- conversation repair --------------------------------------------------------------

def faults(rows):
    """``(role, must go, cut off)`` and the counts of first faults."""
    seen, out, counts = set(), [], Counter()
    for role, text in rows:
        said = text.strip(WHITE)
        kind = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
        seen.add((role, text))
        counts[kind] += 1
        out.append((role, kind in ("blank", "duplicate"), kind == "truncated"))
    return out, counts


def best_script(rows):
    """Every script with up to two insertions in a gap: least cost, then ASCII."""
    gap = [(), ("u",), ("a",), *itertools.product("ua", repeat=2)]
    ways = []
    for role, gone, cut in faults(rows)[0]:
        more = 3 * cut
        ways.append([("D", 4, "")] + ([] if gone else [("K", more, role[:1] or "?"), ("R", 3 + more, "u"), ("R", 3 + more, "a")]))
    best = None
    for ins in itertools.product(gap, repeat=len(rows) + 1):
        if sum(map(len, ins)) > 3:
            continue
        for edits in itertools.product(*ways):
            cost = 3 * sum(map(len, ins)) + sum(e[1] for e in edits)
            audit, roles = "", ""
            for k, own in enumerate(ins):
                audit += "I" * len(own)
                roles += "".join(own)
                if k < len(edits):
                    audit += edits[k][0]
                    roles += edits[k][2]
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def replay(rows, audit):
    out, at = [], 0
    for edit in audit:
        after = out[-1][0][:1] if out else ""
        need = "assistant" if after == "u" else "user"
        if edit == "I":
            out.append((need, ""))
            continue
        role, text = rows[at]
        at += 1
        if edit != "D":
            out.append((need if edit == "R" else role, text))
    assert at == len(rows)
    return out


ROLES = ["system", "user", "assistant", "tool", "", "user"]
TEXTS = ["a.", "b", "", "c!", "a.", " \t", "what? "]


def test_repair_is_the_cheapest_and_ascii_least_script(spark):
    rng = random.Random(5)
    convs = {c: [(rng.choice(ROLES), rng.choice(TEXTS)) for _ in range(rng.randint(1, 3))] for c in range(250)}
    rows = [(c, t, *x) for c, own in convs.items() for t, x in enumerate(own)]
    rng.shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    report = conversation_repair.repair(turns, spill=2).cache()
    fixed = conversation_repair.apply_repairs(turns, report)
    done = {}
    for r in sorted(fixed.collect(), key=lambda r: (r["conv_id"], r["seq"])):
        done.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    shas = {r[0]: r[1] for r in conversation_repair.text_digests(fixed).collect()}
    for r in report.collect():
        own = convs[r["conv_id"]]
        assert (r["cost"], r["audit"]) == best_script(own)
        assert done.get(r["conv_id"], []) == replay(own, r["audit"])
        counts = faults(own)[1]
        assert (r["rows"], r["gaps"]) == (len(own), 0)
        assert (r["blank"], r["duplicate"], r["truncated"]) == (counts["blank"], counts["duplicate"], counts["truncated"])
        assert r["illegal"] == sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        if r["conv_id"] in done:
            said = "\n".join(f"{a}:{b}" for a, b in done[r["conv_id"]])
            assert shas[r["conv_id"]] == hashlib.sha256(said.encode()).hexdigest()
    assert len(shas) == len(done) and report.count() == len(convs)


def test_giant_conversation_spills_and_equals_memory(spark):
    rng = random.Random(2)
    rows = [(7, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["x.", f"t{t % 900}.", f"t{t}", ""])) for t in range(6000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    small, large = conversation_repair.repair(turns, spill=100).first(), conversation_repair.repair(turns).first()
    assert small == large and small["rows"] == 6000 and small["duplicate"] == faults([r[2:] for r in rows])[1]["duplicate"]
    fixed = conversation_repair.apply_repairs(turns, conversation_repair.repair(turns, spill=100)).orderBy("seq").collect()
    assert [(r["role"], r["text"]) for r in fixed] == replay([r[2:] for r in rows], small["audit"])
    assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in fixed))


def test_repair_of_odd_tables(spark):
    kind = "conv_id long, turn long, role string, text string, c string, n long, audit int, kind string, rows long"
    more = ("c", 1, 2, "k", 3)
    rows = [(None, None, "user", "hi.", *more), (None, 3, "assistant", "yo.", *more), (1, None, None, None, *more),
            (2, 5, "user", LONG, *more), (2, 9, "assistant", "b.", *more), (2, 9, "assistant", "a.", *more), (2**60 + 1, 1, "user", "x.", *more)]
    turns = spark.createDataFrame(rows, kind)
    got = {r["conv_id"]: r for r in conversation_repair.repair(turns).collect()}
    assert set(got) == {None, 1, 2, 2**60 + 1}
    assert (got[None]["audit"], got[None]["gaps"], got[None]["cost"]) == ("KK", 0, 0)
    assert (got[1]["audit"], got[1]["blank"], got[1]["cost"]) == ("D", 1, 4)  # one space
    assert (got[2]["gaps"], got[2]["audit"], got[2]["cost"]) == (3, "KKIK", 3)  # equal turns by text
    assert (got[2**60 + 1]["audit"], got[2**60 + 1]["cost"]) == ("KI", 3)
    fixed = conversation_repair.apply_repairs(turns, conversation_repair.repair(turns))
    assert [r["text"] for r in fixed.filter("conv_id = 2").orderBy("seq").collect()] == [LONG, "a.", "", "b."]
    gone = conversation_repair.repair(turns, dropped=F.lit(True)).collect()
    assert len(gone) == 4 and {tuple(r)[1:] for r in gone} == {(0, 0, 0, 0, 0, 0, 0, "")}
    none = turns.limit(0)
    empty = conversation_repair.repair(none)
    assert empty.count() == 0 and conversation_repair.apply_repairs(none, empty).count() == 0


def test_op11_equals_a_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    convs = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        role, text = " " if r["role"] is None else r["role"], " " if r["text"] is None else r["text"]
        fault = zlib.crc32(f"{' ' if r['conv_id'] is None else r['conv_id']}:{' ' if r['turn'] is None else r['turn']}".encode()) % 20
        own = convs.setdefault(r["conv_id"], [])
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            own += [(r["turn"], "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    got = QUERIES["op11_repair_conversations"](spark, sf).collect()
    assert len(got) == len(convs) and got[0].__fields__ == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    for r in got:
        own = sorted(convs[r["conv_id"]])
        rows, turns = [x[1:] for x in own], {x[0] for x in own}
        counts = faults(rows)[1]
        assert r["gaps"] == (max(turns) - min(turns) + 1 - len(turns) if turns else 0)
        assert (r["blank"], r["duplicate"], r["truncated"]) == (counts["blank"], counts["duplicate"], counts["truncated"])
        fixed = replay(rows, r["audit"])
        assert re.fullmatch("(s?(ua)+)?", "".join(a[:1] for a, _ in fixed))
        assert r["repaired_sha256"] == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in fixed).encode()).hexdigest()
        if len(rows) <= 3:
            assert (r["cost"], r["audit"]) == best_script(rows)


# --- collocations -----------------------------------------------------------------------

def phrases(rows, least, top, most=3):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    out = []
    for lang in n:
        found = {p: a for (x, p), a in f.items() if x == lang and len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, _, left, right = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                        for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for i, x in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def odd_texts(seed, rows):
    rng = random.Random(seed)
    words = ["a", "B", "the", "é", "x\x00", "日本", "of", "Of", " ", "zz"]
    apart = [" ", "  ", "\t", ". ", "\n", ", ", " ", "  ", " ", "\r\n", "!"]
    return [(rng.choice(["en", "fr", None, "und", "a\nb", "a\tb", ""]),
             "".join(rng.choice(words) + rng.choice(apart) for _ in range(rng.randint(0, 40)))) for _ in range(rows)]


@pytest.mark.parametrize("most", [2, 3, 4])
def test_collocations_equal_brute_force_over_several_tries(spark, most):
    rows = odd_texts(most, 300) + [(None, None), ("en", ""), ("en", "  "), ("xx", LONG)]
    df = spark.createDataFrame(rows, "lang string, text string").withColumns({"phrase": F.lit(1), "n": F.lit("x"), "words": F.lit(2)})
    got = collocations.collocations(df.repartition(5), min_count=4, max_words=most, top=40, trie_bytes=500)
    assert sorted(map(tuple, got.collect())) == phrases(rows, 4, 40, most)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_collocations_with_crowded_bit_maps_and_empty_table(spark, monkeypatch):
    rows = odd_texts(9, 200)
    df = spark.createDataFrame(rows, "lang string, text string")
    # 256 bits let nearly everything pass: more phrases to look at, the same result
    monkeypatch.setattr(collocations, "SMALLEST", 8)
    monkeypatch.setattr(collocations, "LARGEST", 8)
    got = collocations.collocations(df, min_count=6, top=500)
    assert sorted(map(tuple, got.collect())) == phrases(rows, 6, 500)
    assert collocations.collocations(df.limit(0)).count() == 0


def test_collocations_read_texts_twice_however_many_tries(spark):
    rows = odd_texts(5, 200)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = spark.createDataFrame(rows, "lang string, text string").mapInArrow(counted, "lang string, text string")
    got = collocations.collocations(df, min_count=3, top=500, trie_bytes=20)
    assert sorted(map(tuple, got.collect())) == phrases(rows, 3, 500)
    assert read.value == 2 * len(rows)


@pytest.mark.parametrize("most", [3, 4])
def test_collocations_whose_keys_need_several_integers(spark, monkeypatch, most):
    rows = odd_texts(7, 200)
    monkeypatch.setattr(collocations, "SPACE", 1 << 12)
    monkeypatch.setattr(collocations, "PART", 300)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = collocations.collocations(df, min_count=4, max_words=most, top=500)
    assert sorted(map(tuple, got.collect())) == phrases(rows, 4, 500, most)


def test_phrase_keys_are_exact():
    rng = np.random.default_rng(2)
    for numbers, words, space in ((5, 3, 1 << 64), (300, 4, 1 << 20), ((1 << 31) - 2, 3, 1 << 64)):
        kind = collocations.Keys(numbers, words, space)
        ids = rng.integers(0, numbers, 1000, endpoint=True).astype(np.uint64)
        at = np.arange(1000 - words + 1)
        cols = kind.pack(ids, at)
        assert all((x == ids[at + i].astype(np.int64)).all() for i, x in enumerate(kind.unpack(cols)))
        assert all((x == y).all() for x, y in zip(kind.columns(kind.runs(cols)), cols))
    # keys that share a hash stay apart
    h, a, b = (np.array(x, np.uint64) for x in ([7, 7, 7, 7, 3], [1, 2, 1, 2, 9], [1, 1, 1, 5, 0]))
    for n, want in ((None, [1, 2, 1, 1]), (np.arange(1, 6), [5, 4, 2, 4])):
        run, sums = collocations._combined([h, a, b], n)
        assert [x.tolist() for x in run] == [[3, 7, 7, 7], [9, 1, 2, 2], [0, 1, 1, 5]]
        assert sums.tolist() == want


def test_blocks_of_long_texts_keep_every_phrase():
    rng = random.Random(1)
    text = "".join(rng.choice(["ab", "c", "ddd"]) + rng.choice([" ", "  ", " ", "\t", ". "]) for _ in range(3000)) + "y" * 500 + " ab c"
    want, got = Counter(), Counter()
    for piece in re.split("[.]", text):
        w = piece.split()
        want.update(" ".join(w[i : i + 3]).encode() for i in range(len(w) - 2))
    for _, block, own in collocations.blocks(["en", "en"], [text, None], 3, limit=100):
        line = collocations.Line(block, own)
        for i in np.flatnonzero(line.own).tolist():
            if i + 3 <= len(line.start) and not line.breaks[i : i + 2].any():
                got[line.phrase(i, 3)] += 1
    assert got == want


def test_double_array_holds_exactly_its_keys():
    rng = random.Random(3)
    draw = lambda: bytes(rng.choice(b"abcdefgh \x00\xff") for _ in range(rng.randint(1, 7)))
    keys = sorted({draw() for _ in range(20_000)})
    trie = double_array.build_list(keys)
    assert all(trie.find(k) == e for k, e in zip(keys, trie.ends.tolist())) and len(set(trie.ends.tolist())) == len(keys)
    prefixes = {k[:j] for k in keys for j in range(len(k) + 1)}
    assert all((trie.find(k) >= 0) == (k in prefixes) for k in (draw() for _ in range(20_000)))
    assert double_array.build_list([]).find(b"a") == -1


# --- sentence pieces -----------------------------------------------------------------------

@pytest.fixture(scope="module")
def own():
    return sentence_pieces.Encoder(MODEL, units=300, pairs=500)  # both tables overflow again and again


def test_pieces_equal_the_library_on_odd_texts(own):
    rng = random.Random(1)
    parts = ["▁", " ", "  ", "a", "e", "th", "the", "in", "\n", "é", "日", "本", "\x00", "�", "𐍈", "er", "<", "s", ">", "<0x0A>", "</s>",
             "0", "11", "...", " t", "ion", "\t", "​", "A", "THE", "ﬁ", "́"]
    for _ in range(15_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(own.encode(text), "<i4").tolist() == own.model.encode(text), repr(text)


@pytest.mark.parametrize("text", ["a" * 5000, " " * 333, "ab" * 3000, "日本" * 999, "x" + "=-" * 1000, "aaab" * 700 + " " * 40, LONG[:200_000]])
def test_pieces_of_long_runs(own, text):
    assert np.frombuffer(own.encode(text), "<i4").tolist() == own.model.encode(text)


def test_backtracking_takes_pieces_back(own):
    """Some units need a piece taken back; greedy longest pieces alone differ."""
    words = re.findall("[a-z]+", " ".join(p for p in own.text if p.isascii()))
    rng = random.Random(4)
    differ = 0
    for _ in range(3000):
        unit = "▁" + rng.choice(words) + rng.choice(words)
        at, greedy = 0, []
        while at < len(unit):
            end = next(e for e in range(len(unit), at, -1) if unit[at:e] in own.index)
            greedy.append(own.index[unit[at:end]])
            at = end
        found = own.encode_unit(unit)
        differ += found != greedy
        assert [own.text[k] for k in found] == own.model.encode(unit[1:], out_type=str)
    assert differ > 100


def test_slices_do_not_change_ids(own, monkeypatch):
    text = "Some words, and  more   words \n over here." * 50
    monkeypatch.setattr(sentence_pieces, "SLICE", 37)
    assert np.frombuffer(own.encode(text), "<i4").tolist() == own.model.encode(text)


def test_op13_equals_the_library_and_odd_tables(spark):
    sf = "/root/testdata/sf0.001"
    own = sentence_pieces.encoder(MODEL).model
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op13_sentence_pieces"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = own.encode(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(own.decode(ids).encode()).hexdigest()
    rows = [(1, None, "x", 1), (1, None, "x", 1), (None, "", "y", 2), (3, LONG, "z", 3), (4, " ", "z", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    back = sentence_pieces.decode_ids(sentence_pieces.encode_texts(df, MODEL), MODEL).collect()
    assert sorted((r["doc_id"] or 0, len(r["ids"]), r["text"]) for r in back) == sorted(
        [(1, 0, ""), (1, 0, ""), (0, 0, ""), (3, len(own.encode(LONG)), own.decode(own.encode(LONG))), (4, 1, " ")])
    assert sentence_pieces.encode_texts(df.limit(0), MODEL).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r["text"] for r in sentence_pieces.decode_ids(nulls, MODEL).collect()} == {""}


# --- pipeline on odd tables ---------------------------------------------------------------

def _tables(spark, path, rows):
    import corpus_pipeline  # noqa: F401
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size string, shard string, taken int")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, toxic int, quality int").limit(0).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([("i", None)], "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_pipeline_runs_on_an_empty_table(spark, scratch):
    import corpus_pipeline
    out = corpus_pipeline.run(spark, _tables(spark, f"{scratch}/sf", []))
    assert out.count() == 0 and {"doc_id", "size", "shard", "slot"} <= set(out.columns)


def test_pipeline_stages_keep_columns_with_clashing_names(spark, scratch):
    import corpus_pipeline
    rows = [(i, f"text number {i} " * (i + 3), "en", "a" if i % 2 else None, 5, f"own{i}", "x", -i) for i in range(12)]
    rows += [(None, None, None, None, None, "ownN", None, None), (3, "text number 3 " * 6, "en", "a", 5, "own3", "x", -3)]
    sf = _tables(spark, f"{scratch}/sf", rows)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "shard", "taken"], name
    for r in docs.collect():  # the mix's values do not replace the documents' own
        assert r["size"] == ("ownN" if r["doc_id"] is None else f"own{r['doc_id']}") and r["taken"] == (None if r["doc_id"] is None else -r["doc_id"])
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert out.count() == docs.count() and {r["law"] for r in out.collect()} <= {"bytes"}
