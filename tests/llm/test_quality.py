import numpy as np

from tomeflow.llm import prose, quality

WORDS = [("en", w) for w in "the of and to in is are was for on with as be by this".split()] + [("zh", w) for w in "的 在 是 和 由 并".split()]
PROSE = "The pump in the north hall was moved to the loading dock, and the readings are counted again in the morning. "
LIST = "- pump\n- valve (3)\n- narrow ledger\n- rig\n"


def test_other_chars():
    words = prose.Words(WORDS)
    share = lambda t: (lambda k: 1 - k["prose"] / sum(k.values()))(prose.chars_by_kind(t, words))
    for text in (PROSE, PROSE.upper(), PROSE.replace(" ", "\n", 8), "# head\n\n" + PROSE * 3, "由值班长检查的水泵在北侧厂房，并写明原因。" * 3):
        assert share(text) < 0.1, text
    for text in (LIST, "a,b,c\n1,2,3\n4,5,6", "| a | b |\n| --- | --- |\n| 1 | 2 |", "x = 1\ny = 2\n", '{\n  "a": "' + PROSE + '"\n}', "pump valve pump valve pump valve", "SELECT a FROM t\nWHERE b = 1;"):
        assert share(text) > 0.5, text
    assert not any(prose.chars_by_kind("", words).values()) and not any(prose.chars_by_kind("# a heading", words).values())
    kinds = lambda t: {k for k, n in prose.chars_by_kind(t, words).items() if n}
    assert kinds(LIST) == {"entries"} and kinds("| a | b |\n| --- | --- |\n| 1 | 2 |") == {"rows"} and kinds("```\nx\n```") == {"code"} and kinds(PROSE) == {"prose"} and kinds("pump valve") == {"loose"}
    assert kinds(LIST + "\n" + PROSE) == {"entries", "prose"}


def test_frames(spark):
    rows = [(i, PROSE * (1 + i % 4) if i % 3 else LIST * (1 + i % 5), "x") for i in range(90)] + [(100, None, ""), (101, "", ""), (102, " \n", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    words = spark.createDataFrame(WORDS, "lang string, word string")
    labels = spark.createDataFrame([(0, "list"), (1, "prose"), (3, None)], "doc_id long, kind string")
    assert {r.doc_id for r in quality.not_prose(df, words, labels).collect()} == {i for i in range(90) if i % 3 == 0}
    assert {r.doc_id for r in quality.not_prose(df, words, labels.limit(0)).collect()} == {i for i in range(90) if i % 3 == 0}
    q = quality.quality(df, words).toPandas().set_index("doc_id")
    assert q.loc[100].n_words == 0 and np.isnan(q.loc[101].score)
    x = q[q.lang.notna()]
    want = np.zeros(len(x))
    for name, side in quality.SIDES.items():
        for lang in set(x.lang):
            at = np.flatnonzero(x.lang == lang)
            v = x[name].values[at]
            tail = np.array([(v >= a).mean() if side > 0 else (v <= a).mean() for a in v])
            want[at] -= np.log(tail)
    assert np.allclose(x.score.values, want, atol=1e-5)
    assert quality.not_prose(df.limit(0), words, labels).count() == 0


def test_tails_of_all_languages(spark):
    """Ranks among all texts, against a plain version; repeated values and small languages included."""
    rng = np.random.default_rng(5)
    langs = rng.choice(["en", "de", "und"], 200, p=[0.6, 0.38, 0.02])
    rows = [(i, str(langs[i]), 3, *[round(float(v), 1) for v in rng.random(len(quality.SIDES))]) for i in range(200)]
    stats = spark.createDataFrame(rows, "doc_id long, " + quality._FIELDS)
    got = quality.tails(stats).toPandas().set_index("doc_id").sort_index()
    x = stats.toPandas().set_index("doc_id")
    for name, side in quality.SIDES.items():
        v = x[name].values
        beyond = lambda a, among: (among >= a).mean() if side > 0 else (among <= a).mean()  # noqa: B023, E731
        assert np.allclose(got[f"{name}_of_all"], [-np.log(beyond(a, v)) for a in v])
        assert np.allclose(got[name], [-np.log(beyond(a, v[x.lang.values == g])) for a, g in zip(v, x.lang)])


def test_the_score_alone_separates_the_labels(spark):
    """Texts that weren't labelled are told apart although a tenth of the labels is wrong; the score does it, without any other test."""
    rng = np.random.default_rng(11)
    other = [LIST, "a,b,c\n1,2,3\n4,5,6\n", "| a | b |\n| --- | --- |\n| 1 | 2 |\n", "x = 1;\ny = f(2);\n", "pump valve pump valve rig\n\n"]
    kinds = rng.random(400) < 0.4
    texts = [other[rng.integers(5)] * int(rng.integers(8, 20)) + PROSE * int(rng.integers(0, 2)) if k else PROSE * int(rng.integers(3, 9)) + LIST * int(rng.integers(0, 2)) for k in kinds]
    words = prose.Words(WORDS)
    truth = {i for i, t in enumerate(texts) if (c := prose.chars_by_kind(t, words))["prose"] * 2 < sum(c.values())}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = [(i, ("list" if i in truth else "prose") if rng.random() > 0.1 else ("prose" if i in truth else "list")) for i in range(0, 400, 4)]
    score = quality.prose_scores(df, spark.createDataFrame(WORDS, "lang string, word string"), spark.createDataFrame(labels, "doc_id long, kind string")).toPandas().set_index("doc_id").score
    held = [i for i in range(400) if i % 4]
    assert np.mean([(score[i] > 0) == (i in truth) for i in held]) >= 0.95
    assert score[[i for i in held if i in truth]].median() > 0 > score[[i for i in held if i not in truth]].median()
