"""Text operators: hard inputs, exact results on small fixtures, brute force where SQL is none."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventmill.llm import (
    chat,
    exact_dedup,
    jaccard_join,
    licenses,
    line_frequency,
    maxent_lm,
    mixing,
    packing,
    pii,
    secrets,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, row string"


def docs(spark, rows):
    """Rows of (doc_id, text[, source]) with extra columns whose names clash with the operators' own."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", "y") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed, n=80):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7))) for _ in range(n))


HARD = [(1, None), (2, ""), (3, "word"), (4, "word"), (4, "word"), (None, "word"), (5, None, None), (6, "é ß 𝄞 \x1c x\n\n"),
        (7, prose(1, 30_000))]


def test_hard_inputs_run_through_every_operator(spark):
    d = docs(spark, HARD)
    n = len(HARD)
    assert exact_dedup.mark(d).count() == n
    assert line_frequency.judge(d).count() == n
    assert pii.find(d).count() == n
    assert licenses.scan(d).count() == n
    assert secrets.scan(d).count() == n
    assert jaccard_join.classes(d).count() == n
    assert maxent_lm.score(d).count() == n
    rows, draws = mixing.mix(d)
    assert mixing.taken_by_document(rows, draws).count() == n
    packed = packing.pack(d).select("doc_id", "start", "doc_tokens").collect()
    assert sum(r["start"] == 0 for r in packed) == n


def test_empty_tables(spark):
    d = docs(spark, HARD).limit(0)
    for df in (exact_dedup.mark(d), line_frequency.judge(d), pii.find(d), licenses.scan(d), secrets.scan(d),
               jaccard_join.classes(d), maxent_lm.score(d), mixing.taken_by_document(*mixing.mix(d)), packing.pack(d)):
        assert df.count() == 0


def test_exact_dedup_keeps_one_row_of_each_group(spark):
    d = docs(spark, [*HARD, *[(100 + i, "hot") for i in range(300)]])
    got = exact_dedup.mark(d).collect()
    groups = Counter((r[1] or "") for r in [*HARD, *[(0, "hot")] * 300])
    for text, size in groups.items():
        sha = hashlib.sha256(text.encode()).hexdigest()
        rows = [r for r in got if r["text_sha256"] == sha]
        assert len(rows) == size and all(r["group_size"] == size for r in rows)
        assert sum(r["kept"] for r in rows) == 1
    assert max(r["keep_id"] for r in got if r["keep_id"]) == 399
    kept = exact_dedup.keep(d)
    assert kept.columns == d.columns and kept.count() == len(groups)


def test_frequent_lines_leave_all_but_one_document(spark):
    rows = [(i, f"Shared  LINE of\tthe host\n{prose(i)}", "a") for i in range(30)]
    rows += [(100 + i, "\n".join([prose(900), prose(901), f"own{i}"]), "b") for i in range(30)]
    d = docs(spark, rows)
    got = {r["doc_id"]: r for r in line_frequency.judge(d).collect()}
    assert sorted(got[i]["n_lost_words"] for i in range(30)) == [0] + [5] * 29
    assert all(got[i]["kept"] for i in range(30))
    assert sum(got[100 + i]["kept"] for i in range(30)) == 1  # the others are depleted
    texts = [r["text"] for r in line_frequency.clean(d).collect()]
    assert len(texts) == 31 and sum(t.startswith("Shared") for t in texts) == 1


def test_lines_in_small_shares_of_a_large_host_are_removed(spark):
    tenth, hundredth, rare = prose(901), prose(902, 6), prose(903, 5)

    def text(i):
        more = [line for line, step in ((tenth, 10), (hundredth, 100), (rare, 200)) if i % step == 0]
        return "\n".join([prose(1000 + i, 60), *more])

    d = docs(spark, [(i, text(i), "large") for i in range(4000)])
    lost = {r["doc_id"]: r["n_lost_words"] for r in line_frequency.judge(d).collect()}
    assert all(lost[i] == 0 for i in range(4000) if i % 10)
    assert Counter(lost[i] for i in range(0, 4000, 10) if i % 100)[80] >= 359  # 10 %, all but one text
    assert Counter(lost[i] for i in range(0, 4000, 100))[86] >= 38  # 1 %: 40 texts hold the line
    texts = [r["text"] for r in line_frequency.clean(d).collect()]
    counts = [sum(line in t.split("\n") for t in texts) for line in (tenth, hundredth, rare)]
    assert len(texts) == 4000 and counts == [1, 1, 20]


@pytest.mark.parametrize("text", ["a b c a b c", "x x x x", "a b c d", "a b c a b c a b", "", "one"])
def test_repeated_words(spark, text):
    ws = text.split()
    windows = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    want = len({i + j for i in range(len(ws) - 2) if windows[tuple(ws[i : i + 3])] > 1 for j in range(3)})
    got = line_frequency.judge(docs(spark, [(1, text)])).first()
    assert got["n_repeat_words"] == want


def test_personal_data_spans(spark):
    text = "é a.b@c.de_f@g.hi 1.2.3.4.5.6.7.8 999.1.1.1 4111 1111 1111 1111 +1 (555) 010-9999. account DE89370400440532013000"
    found = pii.find(docs(spark, [(1, text)])).first()["found"]
    assert [text[s["start"] : s["end"]] for s in found["email"]] == ["a.b@c.de", "_f@g.hi"]
    assert [s["match"] for s in found["ip"]] == ["1.2.3.4", "5.6.7.8"]
    assert [text[s["start"] : s["end"]] for s in found["card"]] == []
    assert [s["match"] for s in found["phone"]] == ["+1 (555) 010-9999"]
    assert [(s["match"], s["score"]) for s in found["iban"]] == [("DE89370400440532013000", 1.0)]
    many = " ".join(f"u{i}@x.org" for i in range(1000))
    spans = pii.find(docs(spark, [(1, many)])).first()["found"]["email"]
    assert len(spans) == 1000 and all(many[s["start"] : s["end"]] == s["match"] for s in spans)


def test_luhn(spark):
    found = pii.find(docs(spark, [(1, "card 4111-1111-1111-1111, 4111111111111112")])).first()["found"]
    assert [s["match"] for s in found["card"]] == ["4111-1111-1111-1111"]


def test_secrets_of_random_text_are_found_and_words_are_not(spark):
    rng = random.Random(5)
    alphabet = secrets.ALPHABETS["base62"]
    key = "".join(rng.choice(alphabet) for _ in range(64))
    rows = [(i, f"{prose(i)} {'xyzxywzxyw' * 5}") for i in range(40)] + [(100, f"key {key} end")]
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(docs(spark, rows)).collect()}
    assert [(s["start"], s["kind"], s["end"]) for s in got[100]] == [(4, 3, 68)]
    assert not any(got[i] for i in range(40))
    base = secrets.base_spans('token: token: abcdefgh12 PASSWORD = "abcdefgh" AKIA' + "A" * 12 + " " + "0f" * 16)
    assert [k for _, k, _ in base] == [0, 1, 2]


def test_conversations_of_all_layouts(spark):
    schema = ("conv_id long, messages array<struct<role:string,content:string>>, instruction string, input string, "
              "output string, prompt string, completion string, conversations array<struct<from:string,value:string>>")
    rows = [
        (1, [("user", "hi"), ("assistant", "<|im_end|>\n")], None, None, None, None, None, None),
        (2, None, "do", None, "done", None, None, None),
        (3, None, None, None, None, "p", "c\\", None),
        (4, None, None, None, None, None, None, [("human", "q"), ("gpt", None)]),
        (5, None, None, None, None, None, None, None),
    ]
    turns = chat.canonical(spark.createDataFrame(rows, schema))
    got = {(r["conv_id"], r["part"]): (r["role"], r["text"]) for r in turns.filter("layout IS NOT NULL").collect()}
    assert got[(2, 0)] == ("user", "do") and got[(2, 1)] == ("assistant", "done")
    assert got[(4, 0)] == ("user", "q") and got[(4, 1)] == ("assistant", "")
    segments = chat.format_turns(turns)
    back = {(r["conv_id"], r["part"]): r for r in chat.read_back(segments).collect()}
    for key, (role, text) in got.items():
        if role is not None:
            assert (back[key]["role"], back[key]["text"]) == (role, text)
            assert back[key]["loss_text"] == (text if role == "assistant" else None)
    assert {r["conv_id"] for r in chat.assemble(segments).collect()} == {1, 2, 3, 4}


@pytest.mark.parametrize("clash", ["system", "input", "output", "context", "prompt", "response", "instruction"])
def test_turn_rows_with_clashing_columns(spark, clash):
    rows = [(1, 0, "user", "a", "more"), (1, 1, "assistant", "b", None), (1, 2, None, "c", "more"), (1, 3, "user", None, "x")]
    table = spark.createDataFrame(rows, f"conv_id long, turn long, role string, text string, {clash} string")
    turns = chat.read_back(chat.format_turns(chat.canonical(table, order="turn"))).orderBy("turn").collect()
    assert [(r["role"], r["text"]) for r in turns] == [("user", "a"), ("assistant", "b"), ("", "c"), ("user", "")]


def test_records_without_a_layout_stay_visible(spark):
    schema = "conv_id long, instruction string, prompt string, output string, text string"
    rows = [(1, "do", None, "done", "all of it"), (2, "do", "p", None, None)]
    both = spark.createDataFrame(rows, schema)
    first = chat.format_turns(chat.canonical(both.filter("conv_id = 1"))).collect()
    assert len(first) == 2  # a lone text column leaves the other layouts alone
    segments = chat.format_turns(chat.canonical(both.drop("text")))
    assert [(r["conv_id"], r["segment"]) for r in segments.filter("segment IS NULL").collect()] == [(2, None)]
    assert {r["conv_id"] for r in chat.assemble(segments).collect()} == {1}


@pytest.mark.parametrize("text", ["</s>[INST] ok [/INST]", "<\\/s> [\\INST]", "<", "<|im_end", "a\\\n\\n", "<<s><|x|>\\", ""])
def test_escapes_are_reversible(spark, text):
    one = spark.createDataFrame([(1, 0, text, text)], "conv_id long, turn long, role string, text string")
    segments = chat.format_turns(chat.canonical(one, order="turn"))
    body = segments.first()["segment"][len(chat.START) : -len(chat.END) - 1]
    assert not any(c in body for c in ("</s>", "[INST]", "[/INST]", "<|im_end|>", "<|x|>"))
    back = chat.read_back(segments).first()
    assert (back["role"], back["text"]) == (text, text)


def test_licenses(spark):
    notice = licenses.TEMPLATES[1][1]
    rows = [(1, "Under the MIT License"), (2, f"{prose(1)}\n{notice.upper()}\n{prose(2)}"), (3, prose(3, 500)),
            (4, "cc-by-nc CC BY NC, cc by nc"), (5, notice[: len(notice) // 3])]
    got = {r["doc_id"]: r for r in licenses.scan(docs(spark, rows)).collect()}
    assert (got[1]["base_labels"], got[1]["first_word"], got[1]["n_base"]) == ("mit", 0, 1)
    assert (got[2]["labels"], got[2]["base_labels"], got[2]["score"]) == ("mit", "", 1.0)
    assert (got[3]["labels"], got[3]["score"]) == ("", 0.0)
    assert (got[4]["n_base"], got[4]["first_word"], got[4]["last_word"], got[4]["n_words"]) == (3, 0, 6, 9)
    assert got[5]["labels"] == ""


@pytest.mark.parametrize("template", [1, 3, 5, 9])
@pytest.mark.parametrize("before", [0, 25, 57])
def test_wrapped_licenses(spark, template, before):
    label, notice = licenses.TEMPLATES[template]
    ws = notice.split()
    wrapped = "\n".join(f" * {' '.join(ws[i : i + 8])}" for i in range(0, len(ws), 8))
    text = f"{prose(1, before)}\n{wrapped}\n{prose(2, 200)}"
    got = licenses.scan(docs(spark, [(1, text), (2, "\n".join(ws[: len(ws) // 2]))])).collect()
    assert {r["doc_id"]: (label in r["labels"].split(","), r["score"]) for r in got} == {1: (True, 1.0), 2: (False, 0.0)}


def test_mix_meets_targets_and_materialises_what_it_takes(spark):
    rng = random.Random(3)
    rows = [(i, prose(i, rng.randint(0, 200)), f"s{min(i % 9, 4)}") for i in range(300)] + [(None, "a b", None)]
    d = docs(spark, rows)
    table, draws = mixing.mix(d, carry=True, shard_words=2000)
    got = mixing.taken_by_document(table, draws).collect()
    assert len(got) == len(rows) and all(r["taken"] <= 2 * r["size"] for r in got)
    for source in {r["source"] for r in got}:
        of = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in of) - of[0]["target"]) <= 0.5
    drawn = [[int(x) for x in part.split(":")] for r in got if r["shards"] for part in r["shards"].split(",")]
    assert sum(n for _, n in drawn) == sum(r["taken"] for r in got)
    loads = Counter()
    for shard, n in drawn:
        loads[shard] += n
    assert len(loads) > 1  # the tree deals to several
    again = mixing.taken_by_document(*mixing.mix(d.repartition(3))).collect()
    assert sorted((str(r["doc_id"]), r["taken"]) for r in again) == sorted((str(r["doc_id"]), r["taken"]) for r in got)
    mixed = mixing.materialise(draws).collect()
    assert sum(len(r["text"].split()) for r in mixed) == sum(r["taken"] for r in got)


def test_fill_is_a_common_level_under_the_caps():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randint(1, 12)
        sizes, weights = [rng.choice([0, rng.randint(1, 10_000)]) for _ in range(n)], [rng.randint(1, 5) for _ in range(n)]
        total = 1.5 * sum(sizes)
        low, high = 0.0, 2.0 * max(sizes) + 1  # words a unit of weight, found by bisection
        for _ in range(200):
            level = (low + high) / 2
            reached = sum(min(2.0 * s, level * w) for s, w in zip(sizes, weights)) >= total
            low, high = (low, level) if reached else (level, high)
        want = [min(2.0 * s, high * w) for s, w in zip(sizes, weights)]
        assert np.allclose(mixing.fill(sizes, weights, total, 2.0), want, rtol=1e-6, atol=1e-6)


def test_tree_deals_every_block_once():
    tree = mixing.Tree([7, 0, 20], 3, seed=1)
    shards = Counter((s, tree.shard(s, b)) for s, n in enumerate([7, 0, 20]) for b in range(n))
    assert sum(shards.values()) == 27
    assert set(Counter(x for (_, x), n in shards.items() for _ in range(n)).values()) <= {3, 4}


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(9)
    rows = []
    for g in range(12):
        base = prose(g, rng.randint(30, 300)).split()
        for k in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 60)):
                copy[rng.randrange(len(copy))] = f"new{g}x{k}"
            rows.append((len(rows), " ".join(copy)))
    hot = prose(77, 400).split()  # a dense group beyond the limit of one bucket
    for k in range(400):
        copy = list(hot)
        copy[rng.randrange(400)] = f"hot{k}"
        rows.append((len(rows), " ".join(copy)))
    hashes = jaccard_join.WordHash()
    sets = [jaccard_join.shingles(t, hashes) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    got = {r["doc_id"]: r for r in jaccard_join.classes(docs(spark, rows)).collect()}
    assert [got[i]["class_id"] for i in range(len(rows))] == [root(i) for i in range(len(rows))]
    sizes = Counter(root(i) for i in range(len(rows)))
    assert all((got[i]["n_links"] > 0) == (sizes[root(i)] > 1) for i in range(len(rows)))
    assert jaccard_join.keep_one(docs(spark, rows)).count() == len(sizes)


def test_licenses_that_share_most_words_keep_their_own_labels(spark):
    gpl = ("you can redistribute it and/or modify it under the terms of the GNU {}General Public License as\n"
           "published by the Free Software Foundation, either version 3 of the License")
    cases = {
        "Released under the Apache License": "",
        "Copyright released under the BSD license": "",
        "the new film was released under the old title, and its license ran out": "",
        "Released under the MIT license": "mit",
        "Licensed under CC BY 4.0": "cc-by",
        "Licensed under CC BY-NC 4.0": "cc-by-nc",
        gpl.format(""): "gpl-3",
        gpl.format("Lesser "): "lgpl",
        "Licensed under a Creative Commons Attribution 4.0 International License": "cc-by",
        "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa",
    }
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(docs(spark, list(enumerate(cases)))).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


def test_link_counts_against_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for g in range(14):
        base = prose(g, 200).split()
        for k in range(rng.randint(2, 9)):
            copy = list(base)
            for _ in range(rng.randint(1, 6)):
                copy[rng.randrange(200)] = f"n{g}x{k}"
            rows.append((len(rows), " ".join(copy)))
    alike = prose(50, 300).split()
    for k in range(30):
        rows.append((len(rows), " ".join([*alike[:k], f"own{k}", *alike[k + 1 :]])))
    rows.append((len(rows), rows[-1][1]))  # a copy is a link of its own
    hashes = jaccard_join.WordHash()
    sets = [jaccard_join.shingles(t, hashes) for _, t in rows]

    def linked(x, y):
        both = len(np.intersect1d(x, y, assume_unique=True))
        return both >= 0.8 * (len(x) + len(y) - both) - 1e-9

    want = [sum(linked(x, y) for y in sets) - 1 for x in sets]
    got = {r["doc_id"]: r["n_links"] for r in jaccard_join.classes(docs(spark, rows)).collect()}
    assert [got[i] for i in range(len(rows))] == want and want[-2] == 30


def test_pairs_in_a_large_group_with_a_shared_passage(spark):
    passage, rows = prose(60, 190), []
    for k in range(600):
        common = prose(1000 + k, 16)
        rows += [(2 * k + i, f"{passage} {common} {prose(9000 + 2 * k + i, 20)}") for i in range(2)]
    got = {r["doc_id"]: r["class_id"] for r in jaccard_join.classes(docs(spark, rows)).collect()}
    assert sum(got[2 * k] == got[2 * k + 1] == 2 * k for k in range(600)) >= 594
    assert all(c in (i, i - i % 2) for i, c in got.items())


def test_every_link_of_a_large_group_is_counted(spark):
    # Beyond one tile: copies with 1 to 10 % of the words changed, some at the threshold, some below.
    rng, base, rows = random.Random(5), prose(70, 120).split(), []
    for k in range(700):
        copy = list(base)
        for _ in range(rng.randint(1, 3)):
            copy[rng.randrange(120)] = f"own{k}x{rng.randrange(9)}"
        rows.append((k, " ".join(copy[: 120 - rng.randrange(12)])))
    hashes = jaccard_join.WordHash()
    sets = [jaccard_join.shingles(t, hashes) for _, t in rows]
    size, both = np.array([len(x) for x in sets]), jaccard_join.overlaps(sets)
    linked = 10 * both >= 8 * (size[:, None] + size[None, :] - both)
    np.fill_diagonal(linked, False)
    got = {r["doc_id"]: r["n_links"] for r in jaccard_join.classes(docs(spark, rows)).collect()}
    want = linked.sum(axis=1).tolist()
    assert [got[k] for k in range(700)] == want and 50 < np.mean(want) < 350


def test_parities_differ_no_more_than_the_sets():
    rng = np.random.Generator(np.random.PCG64(3))
    for n in (1, 5, 70, 900):
        both, x, y = (rng.integers(0, 1 << 63, k).astype(np.uint64) for k in (n, n // 4, n // 3))
        a, b = (jaccard_join.parities(np.concatenate([both, z])) for z in (x, y))
        words = min(len(a), len(b))
        apart = int(np.bitwise_count(jaccard_join.folded(a, words) ^ jaccard_join.folded(b, words)).sum())
        assert 0.6 * (len(x) + len(y)) <= apart <= len(x) + len(y)


def test_pairs_at_the_threshold_among_texts_with_a_shared_passage(spark):
    passage, rows = prose(61, 190), []
    for k in range(400):
        common = prose(3000 + k, 16)
        rows += [(2 * k + i, f"{passage} {common} {prose(19000 + 2 * k + i, 20)}") for i in range(2)]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join.classes(docs(spark, rows)).collect()}
    assert got == {i: (i - i % 2, 1) for i in range(800)}


def test_texts_that_share_a_phrase_by_chance_are_hardly_compared(spark, monkeypatch):
    rng, phrases, rows = random.Random(8), [prose(400 + k, 6) for k in range(150)], []
    for k in range(1200):
        parts = [prose(30_000 + k, rng.randint(40, 160)), *rng.sample(phrases, 5)]
        rows.append((k, " ".join(parts)))
    rows += [(5000 + k, rows[k][1] + f" more{k}") for k in range(0, 1200, 40)]
    compared, bounds = spark.sparkContext.accumulator(0), jaccard_join.alike_parities

    def counting(threshold):
        run = bounds(threshold)

        def count(batches):
            for batch in batches:
                compared.add(len(batch))
                yield batch

        return lambda batches: run(count(batches))

    monkeypatch.setattr(jaccard_join, "alike_parities", counting)
    monkeypatch.setattr(jaccard_join, "FREQUENT_FROM", 10_000)  # as if the sample held each phrase once
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join.classes(docs(spark, rows)).collect()}
    pairs = {k for k in got if k >= 5000}
    want = {i: (i % 5000, int(i >= 5000 or i + 5000 in pairs)) for i in got}
    assert got == want and len(pairs) == 30
    assert compared.value < 10_000


def test_prefixes_and_bits_of_texts_are_written_once(spark, monkeypatch):
    written, stage = {}, jaccard_join.stage

    def noting(df, name, *partition_by):
        written.setdefault(name, set()).update(df.columns)
        return stage(df, name, *partition_by)

    monkeypatch.setattr(jaccard_join, "stage", noting)
    rows = [(i, prose(i % 30, 120) + (f" tail{i}" if i % 3 else "")) for i in range(90)]
    kept = corpus_pipeline.near_duplicates(spark, docs(spark, rows), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(30))
    assert [name for name, columns in written.items() if columns & {"prefix", "odd"}] == ["sketches"]


def test_packing_holds_every_token_once(spark):
    rng = random.Random(2)
    rows = [(i, prose(i, rng.randint(0, 900)) + " It's 12% <|endoftext|>, naïve x") for i in range(60)]
    got = packing.pack(docs(spark, rows)).collect()
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(packing.tokenizer_path())
    for doc_id, text in rows:
        ids = np.array([*model.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        pieces = sorted((r for r in got if r["doc_id"] == doc_id), key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in pieces) == ids.tobytes()
        assert all(zlib.crc32(bytes(r["ids"])) == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) for r in pieces)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end & (end - 1) == 0 and end <= 2048


def test_words_with_signs_behind_are_encoded_in_parts(monkeypatch):
    from tokenizers import Tokenizer

    from eventmill.llm.tokens import SIGNS, WordTokens

    tokens, model = WordTokens(packing.tokenizer_path()), Tokenizer.from_file(packing.tokenizer_path())
    plain = [f"heat{SIGNS[i:i + 3].decode()} naïve{SIGNS[i:i + 2].decode()} Word{SIGNS[i:i + 1].decode()}" for i in range(len(SIGNS))]
    odd = "don't it's's <|endoftext|> a1% $5 a'% x<|endoftext|>"
    want = [np.array(model.encode(t, add_special_tokens=False).ids, dtype="<u2").tobytes() for t in [*plain, odd]]
    assert tokens.ids([odd]) == want[-1:]
    monkeypatch.setattr(tokens, "_single", None)
    assert tokens.ids(plain) == want[:-1]


def test_words_of_common_signs_are_encoded_without_the_whole_way(monkeypatch):
    from tokenizers import Tokenizer

    from eventmill.llm.tokens import WordTokens

    tokens, model = WordTokens(packing.tokenizer_path(), stored=20), Tokenizer.from_file(packing.tokenizer_path())

    def want(texts):
        return [np.array(model.encode(t, add_special_tokens=False).ids, dtype="<u2").tobytes() for t in texts]

    common = ["It's 12% of $3,400.50 (ÉTÉ naïve) x-y_z's", "don't 'tis I'LL a'% \"quoted.\" http://a.b/c?d=1", "a1b22 ß ÿ É. ..."]
    rng = random.Random(7)
    signs = [*"abEHJTWYK01 \t\n''.,%<|>", "\u0301", "\u0331", "\u030c", "é", "\u00d7", "\u00b5", "\u00a0", "\u0085", "\u0130", "\u212a",
             "\x1c", "<|endoftext|>", "<|ENDOFTEXT|>"]
    mixed = ["".join(rng.choice(signs) for _ in range(30)) for _ in range(2000)]
    assert tokens.ids(mixed) == want(mixed)
    monkeypatch.setattr(tokens, "_single", None)
    assert tokens.ids(common) == want(common)


def test_shards_of_more_pieces_than_fit_a_key_are_indexed_alike():
    rng = np.random.default_rng(5)
    pieces = [rng.integers(2, 40, 1 + i % 3).astype("<u2") for i in range(300)]
    few, many = packing.Index(pieces), packing.Index([*pieces, *[np.array([1], dtype="<u2")] * 65_400])
    for index, n in ((few, 300), (many, 65_700)):
        for i in range(0, 300, 7):
            terms = index.of_doc[index.doc_first[i] : index.doc_first[i + 1]]
            weight = {}
            for t in terms:
                at = np.arange(index.first[t], index.first[t + 1])
                weight[t] = index.weight[at[index.doc[at] == i]][0]
            assert sorted(index.terms[terms]) == sorted(set(pieces[i].tolist()))
            assert list(terms) == sorted(weight, key=lambda t: (-weight[t], t))
        assert index.n == n and index.doc_first[-1] == len(index.doc)


def test_words_beyond_the_vocabulary_are_counted_exactly(spark, monkeypatch):
    d = docs(spark, [(i, prose(i % 7, 40) + f" own{i}") for i in range(40)])

    def scored():
        return {r["doc_id"]: (r["n_tokens"], r["n_known"], round(r["base_score"], 8)) for r in maxent_lm.score(d).collect()}

    whole = scored()
    monkeypatch.setattr(maxent_lm, "VOCABULARY", 30)
    assert scored() == whole


def test_gradient_sums_of_groups_have_the_bits_of_sums_one_by_one():
    rng = np.random.default_rng(6)
    for n in (1, 9, 400, 30_000):
        values = rng.random((n, 6)).astype(np.float32)
        rows = np.sort(np.minimum(rng.zipf(1.3, n), 5000))
        begin = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        sizes = np.diff(np.append(begin, n))
        order, large_first = rng.permutation(n), np.argsort(-sizes, kind="stable")
        got = maxent_lm.group_sums(values, order, begin[large_first], sizes[large_first])
        assert (got == np.add.reduceat(values[order], begin, axis=0)[large_first]).all()


def test_language_model_beats_the_base_on_held_out_texts(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):  # every word but the first follows from the one before
        at, ws = rng.randrange(50), []
        for _ in range(40):
            ws.append(f"w{at}")
            at = (at * 7 + 3) % 50 if rng.random() < 0.9 else rng.randrange(50)
        rows.append((i, " ".join(ws)))
    got = maxent_lm.score(docs(spark, rows)).collect()
    held = [r for r in got if r["held_out"]]
    assert held and all(zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in held)
    assert sum(r["score"] for r in held) > 0.8 * sum(r["base_score"] for r in held)
    counts = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 10 for w in [*t.split(), ""])
    total, kinds = sum(counts.values()), len(counts)
    for r in held[:5]:
        ws = [*dict(rows)[r["doc_id"]].split(), ""]
        want = sum(np.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in ws)
        assert abs(r["base_score"] - want) < 1e-9 * abs(want) and r["n_known"] == sum(w in counts for w in ws)


def test_words_beyond_the_head_are_predicted_from_context(spark):
    rng, rows = random.Random(6), []
    for i in range(1500):  # 2,000 words, most of them beyond the classes' 480; each follows from the one before
        at, ws = rng.randrange(2000), []
        for _ in range(60):
            ws.append(f"w{at}")
            at = (at * 7 + 3) % 2000 if rng.random() < 0.95 else rng.randrange(2000)
        rows.append((i, " ".join(ws)))
    held = [r for r in maxent_lm.score(docs(spark, rows)).collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.75 * sum(r["base_score"] for r in held)


def some_model(seed):
    rng = np.random.default_rng(seed)
    weights = np.zeros(maxent_lm.SLOTS)
    weights[:3000] = np.sort(rng.integers(1, 10_000, 3000))[::-1] + 0.1
    weights[maxent_lm.RANKED :] = 0.1 + rng.integers(0, 3, maxent_lm.SHARED)
    model = maxent_lm.Model(weights, 1e6)
    model.weights[:] = rng.normal(0, 0.5, len(model.weights))
    return model, weights, rng


def test_probabilities_of_all_slots_add_up_to_one():
    model, weights, _ = some_model(1)
    slots = np.flatnonzero(weights)
    ids = np.stack([np.full(len(slots), 5), np.full(len(slots), 50_000), slots], axis=1).ravel()
    logs = model.log10(ids, np.arange(0, len(ids), 3))[2::3]
    share = np.where(slots >= maxent_lm.RANKED, weights[slots], 1)  # of all words of a shared slot
    assert abs((10**logs * share).sum() - 1) < 1e-5


def test_gradient_against_differences():
    model, weights, rng = some_model(2)
    ids = rng.choice(np.flatnonzero(weights), 400)
    first = np.arange(0, 400, 50)
    g, h = np.zeros_like(model.weights), np.zeros_like(model.weights)
    model.gradient(ids, first, 0, g, h)
    way = rng.normal(0, 1, len(g)).astype(np.float32) * (g != 0)
    start = model.weights.copy()

    def total(step):
        model.weights[:] = start + step * way
        return model.log10(ids, first).sum() * np.log(10)

    want = (total(1e-2) - total(-1e-2)) / 2e-2
    assert abs(want - g @ way) < 2e-3 * np.linalg.norm(g) * np.linalg.norm(way) and (h >= 0).all()


def test_long_texts_are_scored_in_pieces_of_bounded_size(monkeypatch):
    model, weights, rng = some_model(3)
    texts = [rng.choice(np.flatnonzero(weights), n).astype("<u2") for n in (1, 700, 3, 0, 20, 101)]
    batch = pd.DataFrame({"n": [len(x) for x in texts if len(x)], "ids": [x.tobytes() for x in texts if len(x)]})

    def scored():
        scores, sizes = np.zeros(len(batch)), []
        for ids, first, lead, numbers in maxent_lm.chunks(batch):
            scores[numbers] += np.add.reduceat(model.log10(ids, first, lead), first)
            sizes.append(len(ids))
        return scores, max(sizes)

    whole, _ = scored()
    monkeypatch.setattr(maxent_lm, "BATCH_TOKENS", 50)
    pieces, most = scored()
    assert most <= 52 and np.allclose(whole, pieces)


def test_tables_grow_with_the_square_root_of_the_tokens():
    assert [maxent_lm.times(n) for n in (0, 1000, 1 << 25, 1 << 27, 1 << 33, 1 << 60)] == [1, 1, 1, 2, 16, 32]
    rows = np.random.default_rng(4).integers(0, 1 << 19, 5000).astype(np.uint32)
    assert (maxent_lm.by_row(rows) == np.argsort(rows, kind="stable")).all()


def test_pipeline_stages(spark, tmp_path):
    rows = [(i, prose(i % 40, 120) + (f" tail{i}" if i % 3 else ""), f"s{i % 3}") for i in range(120)] + [(500, "short")]
    d = docs(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    d.write.parquet(str(tmp_path / "documents.parquet"))
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    counts = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, at, str(tmp_path)).write.parquet(str(tmp_path / f"out{k}"))
        at = spark.read.parquet(str(tmp_path / f"out{k}"))
        assert at.columns == d.columns
        counts.append((at.count(), at.select("text").distinct().count()))
    assert counts[0][0] == 120 and counts[1][0] == counts[1][1] and counts[2][0] == 40
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert packed.select(F.sum("length")).first()[0] > 0
