"""Each operator against a plain version on small tables, and the defined
results for nulls, empty and long texts, ties, repeated rows, empty tables and
extra columns with clashing names."""

import hashlib
import os
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, common, decontaminate, mix, pii, quality, range_coder, shard, simhash, token_blocks, topk, toxicity

DOCS = "doc_id long, text string, source string, size long, score string, key int, shard string"
LONG = "one two three four five six seven eight nine ten " * 3000


def docs(spark, texts, sources=None):
    rows = [(i, t, (sources or {}).get(i, "a"), -1, "x", 7, "s") for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


ODD = [(0, None), (1, ""), (2, "   "), (3, "the same words again and again here"), (4, "the same words again and again here"),
       (4, "the same words again and again here"), (5, LONG), (None, "a row without an id stands here"),
       (6, "The SAME words again and again here"), (7, "ünïcode wörds 日本語 mixed in")]


@pytest.fixture(scope="module")
def odd(spark):
    return docs(spark, ODD, {3: None, 5: "b"})


@pytest.fixture(scope="module")
def none(spark):
    return docs(spark, [])


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int, quality int")


# --- 1 -----------------------------------------------------------------------

def test_topk_equals_brute_force_with_ties_and_copies(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 62, 12)
    codes = [(i, int(base[i % 12]) ^ (1 << int(rng.integers(0, 60)) if i % 3 else 0)) for i in range(300)]
    rows = spark.createDataFrame([*codes, (None, 5), (999, None), codes[0]], "id long, code long")
    got = topk.search(rows, rows.filter("id % 50 = 0"), 7).collect()
    for q, c in codes:
        if q % 50 == 0:
            best = sorted((bin((c ^ d) & (2**64 - 1)).count("1"), i) for i, d in codes)[:7]
            assert sorted((r["rank"], r["distance"], r["id"]) for r in got if r["query_id"] == q) == [
                (n + 1, d, i) for n, (d, i) in enumerate(best)]
    assert topk.search(rows.limit(0), rows.limit(0), 3).count() == 0
    few = topk.search(rows.filter("id < 3"), rows.filter("id = 1"), 10)
    assert few.count() == 3


def test_sign_codes(spark):
    v = spark.createDataFrame([(1, [1.0, -1.0, 2.0]), (2, None), (3, [float("nan"), 0.0, 1.0])], "id long, e array<float>")
    assert [r[0] for r in v.orderBy("id").select(topk.sign_codes(F.col("e"))).collect()] == [5, None, 4]


# --- 2 -----------------------------------------------------------------------

def test_chat_round_trip_and_rewriting_template(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\", "<\\s>", "[", "<", "a\nb", "\\[INST]", "[/INST", None, ""]
    rows = [(c, n, "assistant" if n % 2 else "user", nasty[(c + n) % len(nasty)], 1) for c in range(10) for n in range(25)]
    t = spark.createDataFrame([*rows, (None, 0, None, "x", 1)], "conv_id long, turn long, role string, text string, seq int")
    out = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(t)).collect()}
    for c in range(10):
        own = [(r[2], r[3] or "") for r in rows if r[0] == c]
        said = "".join(x for r, x in own if r == "assistant")
        assert out[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in own).encode()).hexdigest()
        assert (out[c]["loss_chars"], out[c]["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert out[c]["formatted_chars"] == len(chat.marked_turns(own)) and out[c]["rewrites"] == 0
    assert out[None]["n_turns"] == 1
    assert chat.format_conversations(t.limit(0)).count() == 0
    numbered = lambda turns: f"{len(turns)}:" + "".join(x for _, x in turns)
    assert any(r for *_, r in chat.render_spans([("user", "a"), ("user", "b")], numbered))
    first = lambda turns: "".join(f"[{i}]{x}" for i, (_, x) in enumerate(turns))
    turns = [("user", str(i)) for i in range(40)]
    assert "".join(p for _, p, _ in chat.render_spans(turns, first)) == first(turns)


CHAT_TEMPLATES = {
    "keep_last_10": lambda turns: "".join(f"<{r}>{t}" for r, t in turns[-10:]),
    "header_from_turn_9": lambda turns: ("[long]" if len(turns) >= 9 else "") + "".join(f"<{r}>{t}" for r, t in turns),
    "system_into_newest_user": lambda turns: "".join(
        f"<{r}>" + "".join(x for q, x in turns if q == "system" and r == "user" and all(z != "user" for z, _ in turns[i + 1 :])) + t
        for i, (r, t) in enumerate(turns) if r != "system"),
    "first_turn_repeated_at_20": lambda turns: "".join(f"<{r}>{t}" + (turns[0][1] if i == 20 else "") for i, (r, t) in enumerate(turns)),
    "marked_turns": chat.marked_turns,
}


@pytest.mark.parametrize("name", CHAT_TEMPLATES)
def test_chat_spans_equal_brute_force_prefixes(spark, name):
    template = CHAT_TEMPLATES[name]
    roles = ["system", "user", *["user", "assistant"] * 19]
    turns = [(r, f"{i} words of turn {i % 7}") for i, r in enumerate(roles)]
    want = []
    for n in range(1, len(turns) + 1):
        a, b = template(turns[: n - 1]), template(turns[:n])
        keep = len(os.path.commonprefix([a, b]))
        want.append((keep, b[keep:], keep < len(a)))
    assert list(chat.render_spans(turns, template)) == want
    t = spark.createDataFrame([(1, i, *turn) for i, turn in enumerate(turns)], "conv_id long, turn long, role string, text string")
    got = chat.format_conversations(t, template).orderBy("seq").collect()
    assert [(r["start"], r["piece"], r["rewrites"]) for r in got] == want
    assert all(r["end"] == r["start"] + len(r["piece"]) == len(template(turns[: r["seq"] + 1])) for r in got)
    assert [r["role"] for r in got] == roles


@pytest.mark.parametrize("name", [n for n in CHAT_TEMPLATES if n != "marked_turns"])
@pytest.mark.parametrize("size", [5, 16, 40, 70])
def test_chat_template_that_breaks_its_declaration_is_rendered_by_prefixes(name, size):
    plain = CHAT_TEMPLATES[name]
    declared = lambda turns: plain(turns)
    declared.local = True
    turns = [("assistant" if i % 2 else "user", f"{i} words") for i in range(size)]
    assert list(chat.render_spans(turns, declared)) == list(chat.render_spans(turns, plain))


def test_chat_of_a_local_template_takes_linear_time():
    rendered = [0]

    def counted(turns):
        rendered[0] += len(turns)
        return chat.marked_turns(turns)

    counted.local = True
    turns = [("assistant" if i % 2 else "user", f"{i} words") for i in range(5000)]
    got = list(chat.render_spans(turns, counted))
    assert "".join(p for _, p, _ in got) == chat.marked_turns(turns) and rendered[0] < 5000 * 20
    assert all(start == end for (start, _, _), end in zip(got, np.cumsum([0, *[len(p) for _, p, _ in got]]).tolist()))


# --- 3 -----------------------------------------------------------------------

def test_pii_base_spans_equal_the_patterns(spark, odd, none):
    texts = ["a@b.c@d.e x@y", "mail und.34@mail7.example.com.", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4", "é+1 (017) 555-7713 +12",
             "4111 1111 1111 1111 4111111111111112", "..@a.b a@b a@b..c", "1" * 5000, "+1" + "." * 3000, "@" * 50 + "a@b.c"]
    for t in texts:
        want = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        want += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
                 if all(int(x) <= 255 for x in m[0].split("."))]
        digits = lambda m: re.sub("[^0-9]", "", m[0])
        want += [(2, *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
        want += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m)) <= 15]
        assert pii.base_spans(t) == want, t[:40]
    found = pii.find_personal_data(docs(spark, list(enumerate(texts)))).collect()
    assert len(found) == len(texts)
    assert pii.find_personal_data(odd).count() == len(ODD)
    assert pii.find_personal_data(none).count() == 0


def test_pii_numbers_beside_other_spans_are_found():
    numbers = lambda t: [t[a:b] for k, a, b in pii.loose_spans(t, pii.base_spans(t)) if k == 5]
    assert numbers("1.2.3.4 5551234567") == ["5551234567"]
    assert numbers("5551234567 1.2.3.4 98765432") == ["5551234567", "98765432"]
    assert numbers("5551234567 12a@b.c") == ["5551234567"]
    assert numbers("abcdefghijklmnopqrst1 55512345") == ["55512345"]
    assert numbers("1.2.3.4 5551") == [] and numbers("") == []
    rng = np.random.default_rng(5)
    parts = ["1.2.3.4", "5551234567", "a1@b.c", "+1 (017) 555-7713", "4111 1111 1111 1111", "abcdefghijklmnopqrst12", "77", "x"]
    for _ in range(500):
        t = "".join(str(rng.choice(parts)) + str(rng.choice([" ", "-", ".", "  ", "/", ", "])) for _ in range(8))
        found = pii.loose_spans(t, pii.base_spans(t))
        rest = t
        for a, b in [x[1:] for x in pii.base_spans(t) + found if x[0] != 5]:
            rest = rest[:a] + "#" * (b - a) + rest[b:]
        assert [x[1:] for x in found if x[0] == 5] == [m.span() for m in pii.NUMBER.finditer(rest)], t


# --- 4 -----------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


@pytest.mark.parametrize("limit", [10**6, 0])
def test_decontamination_equals_brute_force(spark, limit):
    rng = np.random.default_rng(2)
    say = lambda n: " ".join(rng.choice(list("abcdE"), n))
    items = [(1, say(14)), (2, say(10)), (3, "a b"), (4, None), (5, ""), (6, "x " * 30), (7, "a b")]
    texts = [*ODD, *[(100 + i, say(60)) for i in range(30)], (200, "y " + items[0][1].upper() + " z"), (201, "x, " * 40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.hits(docs(spark, texts), bench, limit=limit).collect()
    windows = {}
    for i, t in items:
        w = _words(t)
        n = min(10, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[s : s + n]), set()).add(str(i))
    want = []
    for d, t in texts:
        w, hit, own = _words(t), set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                if k := windows.get(tuple(w[s : s + n])):
                    hit.update(range(s, s + n))
                    own |= k
        want.append((d, len(w), len(hit), tuple(sorted(own))))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in got), key=key) == sorted(want, key=key)


def test_decontamination_of_empty_tables(spark, odd, none):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.keep_clean(odd, empty).count() == len(ODD)
    assert decontaminate.hits(none, empty).count() == 0


# --- 5 -----------------------------------------------------------------------

def test_simhash_components_equal_brute_force(spark, odd, none):
    rng = np.random.default_rng(3)
    seeds = [int(x) for x in rng.integers(0, 1 << 62, 4)]
    fps = {s for s in seeds}
    for s in seeds[:2]:  # two large families, in which buckets are hot
        for _ in range(300):
            fps.add(s ^ sum(1 << int(b) for b in rng.choice(40, int(rng.integers(1, 4)), replace=False)))
    fps = sorted(fps)
    for bucket, bits in ((64, 2), (4, 2), (4, 1)):
        f = spark.createDataFrame([(x,) for x in fps], "fp long")
        root = {r["node"]: r["root"] for r in simhash.components(simhash.links(f, len(fps), bits, bucket)).collect()}
        parent = {x: x for x in fps}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for i, a in enumerate(fps):
            for b in fps[:i]:
                if bin(a ^ b).count("1") <= bits:
                    p, q = find(a), find(b)
                    parent[max(p, q)] = min(p, q)
        assert {x: root.get(x, x) for x in fps} == {x: find(x) for x in fps}
    got = {(r["doc_id"], r["fp"], r["component_id"]) for r in simhash.near_duplicates(odd).collect()}
    assert {(0, 0, 0), (1, 0, 0), (2, 0, 0)} <= got and {c for d, _, c in got if d in (3, 4, 6)} == {3}
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [0, 3, 5, 7]
    assert kept.filter("doc_id is null").count() == 1
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_thresholds_are_dealt_by_least_cost():
    cost = [[1, 5, 50], [2, 3, 50], [100, 200, 300]]
    c, ts = simhash.allocate(cost, 2)
    assert sum(t + 1 for t in ts) == 3 and c == 4 and ts == [0, 1, -1]


# --- 6 -----------------------------------------------------------------------

def test_mix_meets_targets_and_repeats(spark, odd, none):
    rng = np.random.default_rng(4)
    texts = [(i, "w " * int(rng.integers(0, 200))) for i in range(3000)]
    sources = {i: ["a", "b", None, "c", "d"][min(i % 7, 4)] for i in range(3000)}
    d = docs(spark, texts, sources)
    m = mix.systematic_mix(d, cell_rows=100).toPandas()
    per = m.groupby(m["source"].fillna("~")).agg(taken=("taken", "sum"), target=("target", "first"), size=("source_size", "first"))
    assert (abs(per.taken - per.target) <= 0.02 * per.target + 200).all() and (per.target <= 2 * per["size"] + 1e-6).all()
    assert abs(per.target.sum() - 1.5 * per["size"].sum()) < 1e-3 and (m.taken <= 2 * m["size"]).all()
    again = mix.systematic_mix(d.repartition(5), cell_rows=1000).toPandas()
    assert dict(zip(m.doc_id, m.taken)) == dict(zip(again.doc_id, again.taken))
    assert mix.systematic_mix(odd).count() == len(ODD) and mix.systematic_mix(none).count() == 0
    assert mix.emit(mix.systematic_mix(odd), ["doc_id", "text"]).columns == ["doc_id", "text"]


# --- 7, 9 --------------------------------------------------------------------

@pytest.mark.parametrize("op,label,fold", [(toxicity, "toxic", (3, 1)), (quality, "quality", (4, 2))])
def test_scores(spark, odd, none, op, label, fold):
    rng = np.random.default_rng(5)
    say = lambda bad: " ".join(rng.choice(["alpha", "beta", "gamma", "delta"], 40)) + (" rotten %%% $$$ !!!" * 3 if bad else "")
    texts = [(i, say(i % 3 == 0)) for i in range(600)]
    y = labels(spark, [(i, int(i % 3 == 0), int(i % 3 != 0)) for i in range(600)] + [(10**6, 1, 1), (None, 1, 1), (3, None, None)])
    got = op.score_documents(docs(spark, texts + [(600, None), (601, "")]), y).toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % fold[0] == fold[1] for i in got.doc_id]).all()
    held = got[got.held_out & (got.doc_id < 600)]
    good = held.doc_id % 3 == 0 if label == "toxic" else held.doc_id % 3 != 0
    assert ((held.score > 0.5) == good).mean() > 0.95 and got.score.between(0, 1).all()
    assert op.score_documents(odd, labels(spark, [])).toPandas().score.eq(0.5).all()
    assert op.score_documents(none, y).count() == 0


# --- 8 -----------------------------------------------------------------------

@pytest.mark.parametrize("n,top", [(0, 1), (1, 9), (700, 2), (5000, 1), (70000, 40000), (3000, 2**31)])
def test_range_coder_round_trip(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    block = range_coder.encode_block(ids)
    assert (range_coder.decode_block(block) == ids).all()
    if n:
        with pytest.raises(ValueError):
            range_coder.decode_block(block[:-1] + bytes([block[-1] ^ 1]))


def test_token_blocks_hold_the_tokenizers_ids(spark, odd, none):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    path = P.path("word_bpe_49k.json")
    tk = Tokenizer.from_file(path)
    texts = [*ODD, (8, "<|endoftext|> a <|endoftext|>b"), (9, "á ́x y\x1cz ... don't"), (10, "ΣΑΣ 12 ab")]
    got = token_blocks.token_table(docs(spark, texts), path, block_ids=1000).collect()
    want = sorted((i is not None, i or 0, tk.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in texts)
    at = 0
    for r, (_, i, ids) in zip(sorted(got, key=lambda r: r["start"]), want):
        assert (r["doc_id"] or 0, r["start"], r["n_tokens"]) == (i, at, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert len(got) == len(texts) and token_blocks.token_table(none, path).count() == 0


ALPHABET = ["a", "B", "Z", "é", "É", "ß", "ÿ", "Þ", "×", "÷", "1", "23", "'", "'s", "'RE", "<", "|", "<|endoftext|>", "-", "_", "...", "$", " ", "  ",
            "\n", "\t", "\r", "\x0b", "\x1c", "\xa0", "\u0301", "H\u0331", "İ", "Σ", "日本", "ﬁ", "’s", "ª", "µ", "½", "\u212a", "e\u0301",
            "longlonglonglongword", "LONGLONGLONGLONGÉ", "</w>", "w>", " the", "\x00", "\x7f", "\x85", "\u1100", "\u1161"]


@pytest.mark.parametrize("chunk", [64, 1 << 20])
def test_encoder_gives_the_tokenizers_ids_and_learns_each_piece_once(monkeypatch, chunk):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    path = P.path("word_bpe_49k.json")
    tk, enc = Tokenizer.from_file(path), token_blocks.Encoder(path)
    rng = np.random.default_rng(8)
    texts = [None, "", *("".join(rng.choice(ALPHABET, rng.integers(0, 30))) for _ in range(3000)), "ab cdé " * 100, "x" * 300, "É" * 500 + " z'", " "]
    run = lambda some: [ids.tolist() for all_ids, lens in enc.encode_all(pa.array(some, pa.string())) for ids in np.split(all_ids, np.cumsum(lens)[:-1])]
    monkeypatch.setattr(token_blocks, "CHUNK_BYTES", chunk)
    assert run(texts) == [tk.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    enc.clear()
    # the case of letters and the marks around a word make no pieces of their own
    run(["The word, (the WORD) Été été. The word"] * 2)
    assert enc.n == 1 + len({"the", "word", ",", "(", ")", "été", "."})


def test_tasks_of_a_worker_share_its_encoder(spark):
    P = pytest.importorskip("public_tokenizers")
    path = P.path("word_bpe_49k.json")

    def known(batches):
        for b in batches:
            before = token_blocks.encoder(path).n
            for _ in token_blocks.encoder(path).encode_all(b.column(1).cast(pa.string())):
                pass
            yield pa.RecordBatch.from_arrays([pa.array([os.getpid()]), pa.array([before])], names=["pid", "n"])

    rows = spark.range(60).selectExpr("id", "concat('word', id) AS text").coalesce(1)
    first, again = (rows.mapInArrow(known, "pid long, n long").collect() for _ in range(2))
    if first[-1].pid == again[0].pid:  # Spark may use another worker
        assert again[0].n > first[0].n


def test_range_coder_finds_rare_ids_in_full_cells():
    # most ids as rare as can be, so many share a cell of the probabilities
    rng = np.random.default_rng(4)
    ids = np.concatenate([np.arange(49_000), np.where(rng.random(1 << 18) < 0.9, 7, rng.integers(0, 49_000, 1 << 18))]).astype(np.uint32)
    assert (range_coder.decode_block(range_coder.encode_block(ids)) == ids).all()


# --- 10 ----------------------------------------------------------------------

def test_shards_are_even_and_gapless(spark, odd, none):
    rng = np.random.default_rng(6)
    texts = [(i, "x" * int(rng.integers(1, 400))) for i in range(4000)] + [(9999, "copy " * 40)] * 2000
    d = docs(spark, texts)
    s = shard.histogram_shards(d, cell_rows=50).toPandas()
    by = s.groupby("shard")["size"].sum()
    assert len(by) == 16 and by.max() - by.min() <= 0.01 * by.mean() + 800
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in s.groupby("shard"))
    assert s["size"].sum() == sum(len(t) + 1 for _, t in texts) and len(s) == len(texts)
    o = shard.histogram_shards(odd).toPandas()
    assert len(o) == len(ODD) and o[o.doc_id == 0][["size", "text_crc32"]].values.tolist() == [[1, 0]]
    assert shard.histogram_shards(none).count() == 0


def test_pipeline_runs_end_to_end(spark):
    import corpus_pipeline as C
    out = C.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "text", "lang", "source", "n_chars", "shard", "slot"} <= set(out.columns) and out.count() > 0


def _mild(docs, spark, sf):
    """Rows whose score, summed up for each text alone, is below the threshold."""
    at, weights, b = toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    weight = dict(zip(at.tolist(), weights.tolist()))

    def score(text):
        found = {f for c in common.chunks(pa.array([text or ""])) for f in toxicity.features(c)[0].tolist()}
        return 1 / (1 + np.exp(-(b + sum(weight.get(f, 0.0) for f in found))))

    return Counter(r for r in _rows(docs) if score(r[1]) < 0.7)


def _one_of_each(docs, spark, sf):
    """The smallest id of each component of all pairs of fingerprints (null last)."""
    rows = simhash.near_duplicates(docs.withColumn("doc_id", F.struct("doc_id", "text"))).collect()
    assert Counter(tuple(r["doc_id"]) for r in rows) == Counter(_rows(docs))
    fps = np.array(sorted({r["fp"] for r in rows}), np.int64).view(np.uint64)
    root = {int(x): int(x) for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(fps):
        for y in fps[:i][np.bitwise_count(fps[:i] ^ x) <= simhash.MAX_BITS]:
            root[find(int(x))] = find(int(y))
    best = {}
    for r in rows:
        k, own = find(r["fp"] % 2**64), tuple(r["doc_id"])
        if k not in best or (own[0] is None, own[0] or 0) < (best[k][0] is None, best[k][0] or 0):
            best[k] = own
    return Counter(best.values())


def _clean(docs, spark, sf):
    """Rows without a window of a benchmark item under their id, window by window."""
    windows = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = _words(r["text"])
        n = min(10, len(w))
        windows |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1 if n else 0)}
    sizes = {len(w) for w in windows}
    bad = set()
    for i, t in _rows(docs):
        w = _words(t)
        if any(tuple(w[s : s + n]) in windows for n in sizes for s in range(len(w) - n + 1)):
            bad.add(i)
    return Counter(r for r in _rows(docs) if r[0] not in bad)


def _copies(docs, spark, sf):
    """Rows as often as the mix says."""
    return Counter((r["doc_id"], r["text"]) for r in mix.systematic_mix(docs).collect() for _ in range(r["copies"]))


def _rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_pipeline_stages_equal_plain_versions(spark, tmp_path):
    import corpus_pipeline as C
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    item = next(r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() if len(_words(r["text"])) > 12)
    planted = [(900001, None), (900002, ""), (None, "a row without an id stands here alone"), (900003, f"Before it {item.upper()} and after"),
               (900004, "one id with two texts of which this one is clean"), (900004, f"and this one is not: {item}"),
               (900005, "a repeated row of seven words here"), (900005, "a repeated row of seven words here")]
    docs = docs.unionByName(spark.createDataFrame([(i, t, "en", "planted", 0) for i, t in planted],
                                                  "doc_id long, text string, lang string, source string, n_chars long")
                            .select(*[F.col(f.name).cast(f.dataType) for f in docs.schema]))
    plain = [_mild, _one_of_each, _clean, _copies, lambda d, *_: Counter(_rows(d))]
    docs.write.parquet(f"{tmp_path}/planted")
    docs = spark.read.parquet(f"{tmp_path}/planted")
    for (name, stage), want in zip(C.STAGES, plain, strict=True):
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        out, expected = spark.read.parquet(f"{tmp_path}/{name}"), want(docs, spark, sf)
        assert Counter(i for i, _ in _rows(out)) == Counter(i for i, _ in expected.elements()), name
        if name != "near_duplicates":  # any of the rows that repeat an id may stay there
            assert Counter(_rows(out)) == expected, name
        assert (expected == Counter(_rows(docs))) == (name == "shard"), f"{name} has nothing to do on these rows"
        docs = out
