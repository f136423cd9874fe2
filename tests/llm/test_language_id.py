"""Language ID: held-out accuracy, spans of mixed texts, and Viterbi against all paths."""

import itertools
import time
import zlib

import numpy as np

from showlake.llm import language_id as li
from showlake.llm import queries

EN = ["the house is near the river and they walk there with that dog", "this was where the other people said which things"]
RU = ["дом стоит у реки и они гуляют там с собакой", "это было там где другие люди сказали эти вещи"]
FR = ["la maison est près de la rivière et ils marchent avec ce chien", "c'était là que les autres gens disaient ces choses"]


def small(spark):
    rows = [(i, t, lang) for lang, texts in (("en", EN), ("ru", RU), ("fr", FR)) for i, t in enumerate(texts * 30)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(spark, sf, truth, got):
    rows = got(queries.QUERIES["op9_language_id"](spark, sf))
    assert [r["doc_id"] for r in rows] == [i for i, *_ in truth]
    right = [r["lang_pred"] == lang for r, (_, _, lang, _) in zip(rows, truth, strict=True) if r["held_out"]]
    assert sum(right) >= 0.95 * len(right) > 20
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)


def test_mixed_text(spark):
    model = li.train(small(spark))
    text = f"{EN[0]}. {RU[0]}! {FR[1]}"
    df = spark.createDataFrame([(1, text), (2, "ελληνικά γράμματα"), (3, EN[1].upper()), (4, f"{RU[1]} 東京")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in li.identify(df, model).collect()}
    spans = [(text[s["start"] : s["end"]], s["lang"]) for s in rows[1]["spans"]]
    assert spans == [(EN[0], "en"), (RU[0], "ru"), (FR[1], "fr")]
    assert rows[2]["score"] == 0 and rows[2]["lang_pred"] in ("en", "fr", "ru")
    assert (rows[3]["lang_pred"], rows[4]["lang_pred"]) == ("en", "ru") and rows[3]["score"] > 0.5


def test_long_runs_of_letters(spark):
    """Text without spaces is read to its end, in training as well."""
    joined = ["".join(ts).replace(" ", "").replace("'", "") for ts in (EN, FR)]
    model = li.train(small(spark))
    text = joined[0] * 4 + joined[1] * 8
    ((lang, _, spans),) = model.label([text])
    assert lang == "fr" and [s[2] for s in spans] == ["en", "fr"] and abs(spans[0][1] - len(joined[0] * 4)) <= 64
    assert (spans[0][0], spans[1][1]) == (0, len(text)) and spans[0][1] == spans[1][0]
    rows = [(i, "q" * 64 + t * 3, lang) for lang, t in zip(("en", "fr"), joined, strict=True) for i in range(30)]
    taught = li.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert [x[0] for x in taught.label(joined)] == ["en", "fr"]


def test_oddness(spark):
    """Against the same sums over single n-grams; a text in an unlearned language deviates more than any learned from."""
    model = li.train(small(spark), spread=True)

    def level(words, k):
        found = [model.logs[buckets.astype(int), k].sum() for w in words for buckets, _ in li.grams([w])]
        return sum(found) / sum(3 * len(w) + 3 for w in words), sum(3 * len(w) + 3 for w in words)

    for k, lang in enumerate(model.languages):
        texts = {"en": EN, "ru": RU, "fr": FR}[lang]
        assert np.isclose(model.usual[k, 0], np.mean([level(li.WORD.findall(t), k)[0] for t in texts]), atol=0.02)
    text = "wszyscy ludzie rodzą się wolni"
    ((lang, _, spans, odd),) = model.describe([text])
    assert [s[2] for s in spans] == [lang]
    k = model.languages.index(lang)
    found, n = level(text.split(), k)
    mean, texts, words = model.usual[k]
    assert np.isclose(odd, (mean - found) / np.sqrt(texts + words / n + li.TINY), atol=1e-4)
    learned = [x[3] for x in model.describe(EN + RU + FR)]
    assert odd > 3 * max(learned) and model.describe(["", "東京", "12"])[0][3] == 0
    df = spark.createDataFrame([(1, text), (2, EN[0]), (3, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r["oddness"] for r in li.identify(df, model).collect()}
    assert abs(rows[1] - odd) < 0.01 and rows[2] < 3 and rows[3] == 0


def test_viterbi_and_its_shortcut():
    r = np.random.default_rng(4)
    for _ in range(60):
        scores = -r.integers(0, 9, (r.integers(1, 8), 3)).astype(float)
        model = li.Model(["a", "b", "c"], np.zeros((1, 3)), {}, switch=float(r.integers(1, 12)))

        def value(path):
            gained = sum(scores[i, k] for i, k in enumerate(path))
            return gained - model.switch * sum(a != b for a, b in zip(path, path[1:]))

        best = max(map(value, itertools.product(range(3), repeat=len(scores))))
        assert value(model.path(scores).tolist()) == best
        # label() takes one language for the whole text only if that is a best path
        words = [f"w{chr(97 + i)}" for i in range(len(scores))]
        model.remember(words, scores)
        ((_, _, spans),) = model.label([" ".join(words)])
        names = {"a": 0, "b": 1, "c": 2}
        path = [names[s["lang"] if isinstance(s, dict) else s[2]] for s in spans for w in words if s[0] <= words.index(w) * 3 < s[1]]
        assert value(path) == best


def plain_path(scores, switch):
    best, back = scores[0].tolist(), []
    for row in scores[1:].tolist():
        most = max(best)
        back.append([k if b >= most - switch else best.index(most) for k, b in enumerate(best)])
        best = [max(b, most - switch) + s for b, s in zip(best, row)]
    out = [best.index(max(best))]
    for step in reversed(back):
        out.append(step[out[-1]])
    return out[::-1]


def test_texts_side_by_side():
    """Texts of unequal length, many or few at a step, get the very paths that each has alone, ties included."""
    r = np.random.default_rng(9)
    for n, languages in ((1, 1), (1, 4), (3, 4), (40, 4), (9, 30)):
        sizes = r.integers(1, 60, n)
        sizes[0] = 200
        scores = -np.round(r.random((sizes.sum(), languages)) * 8 * (r.random((sizes.sum(), 1)) < 0.6), 1)
        model = li.Model([f"l{k}" for k in range(languages)], np.zeros((1, languages)), {}, switch=float(r.integers(1, 9)))
        stops = np.cumsum(sizes)
        alone = [plain_path(scores[b - n : b], model.switch) for b, n in zip(stops, sizes, strict=True)]
        assert model.paths(scores, stops).tolist() == list(itertools.chain(*alone))


def test_many_texts_take_less_time_than_one_by_one():
    r = np.random.default_rng(3)
    model = li.Model(list("abcd"), np.zeros((1, 4)), {})
    scores = -np.round(r.random((256 * 400, 4)) * 8, 1)
    took = []
    for run in (lambda: model.paths(scores, np.arange(400, len(scores) + 1, 400)), lambda: [plain_path(x, 12.0) for x in np.split(scores, 256)]):
        start = time.process_time()
        run()
        took.append(time.process_time() - start)
    assert took[0] < took[1] / 2


def test_two_languages_beat_a_third():
    """Both halves gain less than a switch over the best single language, together they gain more."""
    scores = np.array([[0.0, -8, -3]] * 3 + [[-8.0, 0, -3]] * 3)
    model = li.Model(["a", "b", "c"], np.zeros((1, 3)), {}, switch=12.0)
    words = [f"w{x}" for x in "abcdef"]
    model.remember(words, scores)
    ((_, _, spans),) = model.label([" ".join(words)])
    assert [s[2] for s in spans] == ["a", "b"]


def test_odd_rows(spark, odd, none, got):
    model = li.train(small(spark))
    rows = got(li.identify(odd, model))
    assert len(rows) == 10
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 6, 7)} == {"und"}
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (3, 4)} == {"en"}
    assert li.identify(none, model).collect() == []
    untaught = li.train(none)
    assert {r["lang_pred"] for r in li.identify(odd, untaught).collect()} == {"und"}
    assert {r["oddness"] for r in li.identify(odd, li.train(none, spread=True)).collect()} == {0.0}
    assert li.identify(none, li.train(small(spark), spread=True)).collect() == []
    carried = li.identify(odd, model, rows=True)
    assert carried.select("row.*").columns == odd.columns
