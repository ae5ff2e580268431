"""That the operators do their whole job: what a cap, a gate or a narrow radius would leave out."""

import itertools
import math
import random
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from kinweave.llm import html, lines, meet, neardup, queries, toxicity
from kinweave.llm.shared import connected_groups

WORDS = "the of and to in is that it was for on are as with his they at be this from have or by one had not but what all were when we there can an your which their said".split()


def line_of(n, draw):
    return [draw.choice(WORDS) + str(draw.randrange(200)) * (draw.random() < 0.6) for _ in range(n)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def changed(words, n, draw):
    """With n edits of any kind."""
    words = list(words)
    for _ in range(n):
        at = draw.randrange(len(words))
        words[at : at + draw.randrange(2)] = [draw.choice(WORDS)] * draw.randrange(2)
    return words


def test_edit_similarity_alone_links_lines(spark):
    draw, texts = random.Random(4), []
    for k in range(40):
        base = line_of((5, 6, 9, 10, 14, 20, 25, 60)[k % 8], draw)
        texts += [base, *(changed(base, draw.randrange(1, 2 + len(base) // 5), draw) for _ in range(3))]
    texts = [x for x in texts if len(x) >= 5]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if distance(texts[a], texts[b]) <= math.floor(0.2 * max(len(texts[a]), len(texts[b])) + 1e-9):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(texts)], "doc_id long, text string")
    kept = {r["doc_id"] for r in lines.dedup_lines(df).collect() if not r["n_removed"]}
    assert kept == {i for i in range(len(texts)) if find(i) == i} and len(kept) < len(texts) // 2


def test_recall_at_the_threshold(spark):
    """Pairs of lines at the last distance that still counts, in words that no other pair has."""
    draw, pairs = random.Random(15), []
    for k in range(240):
        base = [f"w{k}x{draw.randrange(10**6)}" for _ in range((16, 20, 30, 40, 50, 60, 80, 120)[k % 8])]
        other = list(base)
        for at in draw.sample(range(len(base)), len(base) // 5):
            other[at] = f"w{k}y{draw.randrange(10**6)}"
        pairs.append((base, other))
    rows = [(2 * i + k, " ".join(x)) for i, pair in enumerate(pairs) for k, x in enumerate(pair)]
    got = {r["doc_id"] for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).where("n_removed > 0").collect()}
    assert got <= {2 * i + 1 for i in range(len(pairs))} and len(got) >= 0.95 * len(pairs)


def test_op6_links_by_edit_similarity(spark, tmp_path):
    draw = random.Random(8)
    base = line_of(60, draw)
    other = [*base[:10], "x1", "x2", "x3", "x4", "x5", "x6", *base[16:]]
    spark.createDataFrame([(1, " ".join(base)), (2, " ".join(other))], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["n_removed"] for r in queries.op6_fuzzy_lines(spark, str(tmp_path)).collect()}
    assert got == {1: 0, 2: 1}


def test_near_dedup_links_by_jaccard(spark):
    draw, texts = random.Random(6), []
    for k in range(12):
        base = line_of((3, 30, 100, 300)[k % 4], draw)
        texts += [base, *(changed(base, 1 + e * len(base) // 100, draw) for e in (0, 1, 2, 4, 8)), list(base)]
    texts += [[], []]
    sets = [{tuple(x[i : i + 5]) for i in range(max(1, len(x) - 4))} for x in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame([(i, " ".join(x), "en", "s", 1) for i, x in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.dedup_documents(spark, df, "")
    assert got.columns == df.columns and sorted(r["doc_id"] for r in got.collect()) == [i for i in range(len(texts)) if find(i) == i]
    assert sum(find(i) == i for i in range(len(texts))) < len(texts) - 24


def test_short_and_unspaced_lines(spark):
    chinese = "这是一个没有空格的句子，它在很多文件里出现，所以应该只留下一次。"
    thai = "ข้อความนี้ไม่มีช่องว่างและซ้ำกันในเอกสารหลายฉบับ"
    blob = "q7x" * 30
    rows = [(1, f"All rights reserved.\n\n{chinese}\n{thai}\n{blob}\none two"), (2, f"all rights reserved\n\n{chinese.replace('很多', '许多')}\n{thai}\n{blob[:50]}z{blob[50:]}\none too")]
    rows.append((3, "all rights reserved\n-\n\n短的\n短的"))
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "\none too", 3: "-\n\n短的"}


def restorer():
    counts = Counter()
    for w in [*WORDS * 20, *"i a you idiot stupid fuck loser will all well happy known hello can't see too good".split() * 20]:
        p = [0, 0, *map(toxicity.place, w), 0]
        counts.update((p[i] * toxicity._N + p[i + 1]) * toxicity._N + p[i + 2] for i in range(len(p) - 2))
    return toxicity.Restorer(toxicity.Language({k: 100 * n for k, n in counts.items()}))


def test_long_noise_is_decoded():
    r = restorer()
    assert r.text("stu" + "u" * 70 + "pid") == "stupid" and "stupid" in r.features("x" + " s" + " t" * 80 + " u p i d stu" + "u" * 5000 + "pid")
    long = " ".join("stupid" * 12)
    assert r.text(long).replace(" ", "") == "stupid" * 12 and r.text(long.replace(" ", ".")).replace(".", "") == "stupid" * 12


def test_long_words_are_counted_whole(spark):
    counts = {r["at"]: r["n"] for r in toxicity.trigram_counts(spark.createDataFrame([("ab" * 100 + "xyz",)], "text string")).collect()}
    x, y, z = map(toxicity.place, "xyz")
    assert counts[(x * toxicity._N + y) * toxicity._N + z] == 1


def test_light_noise_is_decoded():
    r = restorer()
    for noisy in ("iiddiioott", "st.up.id", "i-di-ot", "s,t,u,p,i,d", "i d i o t"):
        assert r.text(noisy) in ("idiot", "stupid"), noisy
    assert "fuck" in r.features("fu.ck you") and r.text("s ee") == "s ee"
    assert r.text("y o u i d i o t") == "you idiot" and {"you", "idiot"} <= r.features("y o u i d i o t")
    clean = "all will well happy known hello too good can't well-known see,all 3.14 i-a"
    assert r.text(clean) == clean


def test_main_text_keeps_short_lines_and_hinted_wrappers():
    long = "long sentence " * 25
    assert html.main_text(f"<ul><li><a>x</a><li><a>y</a></ul><h1>Headline of it</h1><p>By one</p><p>Monday</p><p>{long}</p>") == f"Headline of it\nBy one\nMonday\n{long.strip()}"
    advert = "<div class='ad'><p>a</p><p>b</p><p>c</p></div>"
    assert html.main_text(f"<p>{long}</p>{advert}<p>The end.</p>") == f"{long.strip()}\nThe end."
    links = "".join(f"<div><a>link {i}</a></div>" for i in range(6))
    assert html.main_text(f"{links}<p>{long}</p>{links}<p>Copyright</p>") == long.strip()
    for wrapper in ("with-sidebar", "has-sidebar", "social", "page search"):
        page = f"<div class='{wrapper}'><article><h1 class='page-header'>Head</h1><div class='entry-header'>By one</div><p>Text</p>{advert}</article></div><p>Else</p>"
        assert html.main_text(page) == "Head\nBy one\nText", wrapper
    assert html.main_text("<article><p>Text</p></article><div class='comments'><article><p>First!</p></article></div>") == "Text"
    assert html.main_text("<div class='social'><main><p>Text</p></main></div>") == "Text"


def test_repeated_rows_have_lines_of_their_own(spark):
    df = spark.createDataFrame([(1, "one two three four five six\nshort")] * 5, "doc_id long, text string")
    assert {(r["place"], r["words"]) for r in lines.lines(df).collect()} == {(0, 6), (1, 1)}
    assert {(r["text"], r["n_removed"]) for r in lines.dedup_lines(df).collect()} == {(df.first()["text"], 0)}


def test_lines_on_a_common_phrase_meet(spark):
    """Lines that share one phrase, and nothing else of their blocks, with very many lines find their partners there."""
    draw, rows = random.Random(21), []
    for k in range(300):  # of eight words four are the phrase, so that every block a pair has in common is
        a, b, c, d = (f"w{k}{x}" for x in "abcd")
        rows += [(2 * k, f"{a} {b} the common phrase here {c} {d}"), (2 * k + 1, f"{a} {b} the common phrase here {c} other{draw.randrange(10**6)}")]
    made = spark.createDataFrame([(i, 0x10000 * len(t.split(" ")), i, 5, t) for i, t in rows], "h long, la long, root long, key long, line string")
    texts = made.select("h", lines.coded(F.col("line"), 5).alias("coded"))
    met = made.select("key", "h", "la", F.lit(None).cast("long").alias("g"), F.lit(None).cast("long").alias("lb"), F.lit(len(rows)).cast("long").alias("n"))
    groups = made.select("h", "root").limit(0)
    got = {(r["h"], r["g"]) for r in lines.other_pairs(met, groups, texts, 0.8).collect()}
    assert {(2 * k, 2 * k + 1) for k in range(300)} <= got and len(got) < 1000


def test_rare_parts_lose_no_pair(spark):
    """Sets of few numbers, many of them frequent: all pairs that similarity asks for are among those that meet."""
    draw = random.Random(4)
    sets = [sorted({draw.choice((draw.randrange(12), draw.randrange(400))) for _ in range(draw.choice((2, 5, 9, 14)))}) for _ in range(150)]
    sets += [sorted({*s[1:], 500 + i}) for i, s in enumerate(sets) if len(s) > 4]
    for lose in (1, 2, 20):
        items = spark.createDataFrame([(i, i, len(s), lose, s) for i, s in enumerate(sets)], "h long, root long, la long, lose long, parts array<long>")
        got = {(r["h"], r["g"]) for r in meet.rare_pairs(items, F.lit(True)).collect()}
        want = {(a, b) for (a, x), (b, y) in itertools.combinations(enumerate(sets), 2) if max(len(x), len(y)) - len({*x} & {*y}) <= lose}
        assert want <= got, lose


def test_near_copies_on_common_shingles_meet(spark):
    """Documents that share a long passage with many others are compared with all that are alike, not with the next in size only."""
    draw, passage = random.Random(5), [f"p{i}" for i in range(60)]
    texts = []
    for k in range(120):
        own = [f"d{k}x{i}" for i in range(90 + draw.randrange(3))]
        texts += [passage + own, passage + own[:-2] + [f"e{k}"]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r["doc_id"] for r in neardup.first_of_each(spark.createDataFrame(rows, "doc_id long, text string"), most=3).collect()}
    assert got == {2 * k for k in range(120)}


def test_edges_left_after_some_rounds_connect_all(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(80)], "u long, v long")
    some = connected_groups(chain, rounds=2)
    assert {r["root"] for r in connected_groups(some.kinweave_edges).collect()} == {0}


def test_near_dedup_links_by_simhash(spark):
    """The pipeline's near-dedup links what op8's components link, shingles alike or not."""
    base, draw = ["one", "and", "the"] * 200, random.Random(2)
    tail = line_of(60, draw)
    texts = [" ".join(base + tail[:30]), " ".join(base + tail[30:]), " ".join(line_of(50, draw)), " ".join(line_of(50, draw)), None, " "]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    groups = {r["doc_id"]: r["component_id"] for r in neardup.components(df, bits=2).collect()}
    assert groups == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 4} and {r["doc_id"] for r in neardup.first_of_each(df).collect()} == {0, 1, 2, 3, 4}
    assert {r["doc_id"] for r in corpus_pipeline.dedup_documents(spark, df, "").collect()} == {0, 2, 3, 4}


def test_lines_on_a_long_passage_form_few_pairs(spark):
    """Lines that share most of their words with very many lines, but not enough, are not formed as pairs; those that are similar are."""
    draw, passage = random.Random(31), [f"p{i}" for i in range(60)]
    texts = []
    for k in range(150):  # own words: 25 of 85, where 17 edits are allowed
        own = [f"w{k}x{i}" for i in range(25)]
        texts += [passage + own, passage + [draw.choice((w, f"{w}y")) for w in own[:8]] + own[8:]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    made = spark.createDataFrame([(i, 0x10000 * 85, i, 5, t) for i, t in rows], "h long, la long, root long, key long, line string")
    met = made.select("key", "h", "la", F.lit(None).cast("long").alias("g"), F.lit(None).cast("long").alias("lb"), F.lit(len(rows)).cast("long").alias("n"))
    got = {(r["h"], r["g"]) for r in lines.other_pairs(met, made.select("h", "root").limit(0), made.select("h", lines.coded(F.col("line"), 5).alias("coded")), 0.8).collect()}
    assert {(2 * k, 2 * k + 1) for k in range(150)} <= got and len(got) < 1000


def test_words_lacking_are_never_more_than_edits(spark):
    draw, rows = random.Random(32), []
    for n in (5, 20, 90, 700):
        for _ in range(12):
            base = [draw.choice("abcdefgh") if draw.random() < 0.3 else f"w{draw.randrange(4 * n)}" for _ in range(n)]
            other = changed(base, draw.randrange(1 + n // 4), draw)
            rows.append((distance(base, other) if n < 700 else n // 4, " ".join(base), " ".join(other)))
    df = spark.createDataFrame(rows, "d int, a string, b string")
    bits = df.select("d", *[meet.bitmap(lines.counted(lines.coded(F.col(x), 1))).alias(x) for x in "ab"])
    got = bits.select("d", meet.lacking("a", "b").alias("x"), meet.lacking("b", "a").alias("y")).collect()
    assert all(max(r["x"], r["y"]) <= r["d"] for r in got) and sum(max(r["x"], r["y"]) >= 0.7 * r["d"] for r in got) > len(got) / 2


def test_pipeline_compares_families_of_lines_once(spark, monkeypatch):
    """A family of near copies is connected through neighbours; none of its pairs is formed again, whatever else is on its blocks."""
    draw, compared, similar = random.Random(33), [], lines.similar
    base, rows = [f"b{i}" for i in range(40)], []
    for k in range(400):
        words = list(base)
        words[draw.randrange(20)] = f"x{k}"
        rows.append((k, " ".join(words), "en", "s", 1))
    rows += [(400 + k, " ".join(base[20:] + [f"o{k}x{i}" for i in range(20)]), "en", "s", 1) for k in range(3)]

    def counting(pairs, texts, similarity):
        compared.append(pairs.count())
        return similar(pairs, texts, similarity)

    monkeypatch.setattr(lines, "similar", counting)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["doc_id"] for r in corpus_pipeline.dedup_lines(spark, df, "").collect()} == {0, 400, 401, 402}
    assert compared[1] < 400


def test_lines_on_different_phrases_form_no_pairs(spark):
    """Long lines of the same few words, which bitmaps of the words cannot tell apart, are compared with lines on their own phrases only."""
    draw, rows, vocabulary = random.Random(34), [], [f"v{i}" for i in range(200)]
    for phrase in range(3):
        for k in range(69):
            base = [draw.choice(vocabulary) for _ in range(900)]
            rows += [(phrase, " ".join(x)) for x in (base, changed(base, 5, draw))[: 2 if k == 0 else 1]]
    rows = [(i, *x) for i, x in enumerate(rows)]
    made = spark.createDataFrame([(i, 0x10000 * len(t.split(" ")), i, p, t) for i, p, t in rows], "h long, la long, root long, key long, line string")
    texts = made.select("h", lines.coded(F.col("line"), 5).alias("coded"))
    met = made.select("key", "h", "la", F.lit(None).cast("long").alias("g"), F.lit(None).cast("long").alias("lb"), F.lit(70).cast("long").alias("n"))
    got = {(r["h"], r["g"]) for r in lines.other_pairs(met, made.select("h", "root").limit(0), texts, 0.8).collect()}
    assert {(70 * k, 70 * k + 1) for k in range(3)} <= got and all(rows[a][1] == rows[b][1] for a, b in got)


def test_a_block_of_some_lines_has_all_its_pairs_compared(spark):
    """Below the number of lines that makes a block a phrase, pairs are formed by the block alone."""
    made = spark.createDataFrame([(i, 0x10000 * 20, i, 5) for i in range(60)], "h long, la long, root long, key long")
    met = made.select("key", "h", "la", F.lit(None).cast("long").alias("g"), F.lit(None).cast("long").alias("lb"), F.lit(60).cast("long").alias("n"))
    texts = made.select("h", F.lit("").alias("coded")).limit(0)
    assert lines.other_pairs(met, made.select("h", "root").limit(0), texts, 0.8).count() == 60 * 59 // 2
