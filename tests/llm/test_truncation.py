import random

import pandas as pd

from frameloom.llm import truncation
from frameloom.session import read_table

SCHEMA = "eval_id long, source string, prompt string, reference string, prediction string, length int, unit string, key string"
NOUNS = "car bus tram boat horse child dog truck cat van".split()
PLACES = "under the bridge,beside the old wall,in the middle lane,near the river bank,behind the second post,by the station gate".split(",")


def text(rng, n):
    said = [f"the {rng.choice(('red', 'blue', 'small', 'slim'))} {rng.choice(NOUNS)} {rng.choice(('waits', 'turns', 'stops'))} {rng.choice(PLACES)}" for _ in range(n)]
    return ". ".join(x.capitalize() for x in said) + "."


def rows(rng, limit=150):
    out, cut = [], set()
    for i in range(3000):
        whole = text(rng, rng.randint(1, 6))
        source = ("Short_Field", "short-field ", "free")[i % 3]
        said = whole
        if source != "free" and len(whole) > limit:
            said = whole[:limit]
            if not said.endswith("."):
                cut.add(i)
        out.append((i, source, "Say it.", text(rng, 2), said, 1, "u", "k"))
    return out, cut


def test_limit_is_found(spark):
    data, cut = rows(random.Random(1))
    got = {r.key: (r.cut, r.limit) for r in truncation.judged(spark.createDataFrame(data, SCHEMA), "eval_id", "source", "prediction", "reference", "prompt").collect()}
    flagged = {k for k, (c, _) in got.items() if c}
    assert len(flagged & cut) >= 0.97 * len(cut) and len(flagged - cut) <= 0.02 * len(cut)
    assert {limit for c, limit in got.values() if c and limit} == {"150 characters"} or {x.split()[0] for c, x in got.values() if c and x} == {"150"}
    report = {r.source: r for r in truncation.report(spark.createDataFrame(data, SCHEMA)).collect()}
    assert set(report) == {"shortfield", "free"} and report["free"].cut <= 5 and report["shortfield"].at_limit > 300


def test_odd_rows(spark):
    base, _ = rows(random.Random(2), 10_000)
    odd = [
        (-1, None, None, None, None, 1, "u", "k"),
        (-2, "free", "p", "r", "", 1, "u", "k"),
        (-3, "free", "p", "r", "​ \xa0", 1, "u", "k"),
        (-4, "free", "p", "r", " N/A ", 1, "u", "k"),
        (-5, None, None, None, "The red car waits under the", 1, "u", "k"),
        (-6, "free", None, None, '{"target": "The red car waits under the bri', 1, "u", "k"),
        (-7, "free", None, None, '{"target": "the red car waits under the bridge"}', 1, "u", "k"),
        (-8, "free", None, None, "The red car waits under the bri", 1, "u", "k"),
        (-9, "free", None, None, "the red car waits under the bridge", 1, "u", "k"),
        (-10, "free", None, None, "The bus stops. The red car waits " * 3000 + "and the", 1, "u", "k"),
        (-11, "free", "Which object is meant here? Give one phrase.", None, "Which object is meant here? Give", 1, "u", "k"),
        (-8, "free", None, None, "The red car waits under the bri", 1, "u", "k"),
    ]
    got = [r.eval_id for r in truncation.found(spark.createDataFrame(base + odd, SCHEMA)).collect()]
    assert {x for x in got if x < 0} == {-5, -6, -8, -10} and got.count(-8) == 2
    assert truncation.found(spark.createDataFrame([], SCHEMA)).count() == 0
    assert truncation.found(spark.createDataFrame(odd[:4], SCHEMA)).count() == 0


def test_hazards_need_a_spike(spark):
    # a broad bump is usual, a single spike isn't
    lengths = [("a", "characters", 50 + int(random.Random(i).gauss(0, 8))) for i in range(3000)] + [("a", "characters", 62)] * 600
    found = truncation.hazards(spark.createDataFrame(lengths, "source string, unit string, length int")).where("significant").collect()
    assert [r.length for r in found] == [62]


def test_real_rows(spark, data):
    assert truncation.found(read_table(spark, data, "eval_records")).columns == ["eval_id"]


def test_long_words_and_fragments(spark):
    # a fragment of a word of any length is found, and so is a text that only a lexicon shows to be cut
    base, _ = rows(random.Random(3), 10_000)
    long = "donau" + "dampfschiff" * 30 + "kapitän"
    said = [(10_000 + i, "free", None, f"the red bus meets the {long} by the wall", "the blue car waits under the bridge", 1, "u", "k") for i in range(5)]
    odd = [(-1, "free", None, None, f"the red bus meets the {long[:200]}", 1, "u", "k"), (-2, "free", None, None, "the red bus waits notwithstanding", 1, "u", "k")]
    df = spark.createDataFrame(base + said + odd, SCHEMA)
    lexicon = spark.createDataFrame([("The bus waits notwithstanding the rain that falls.",)] * 400, "text string")
    assert {r.eval_id for r in truncation.found(df, lexicon).collect() if r.eval_id < 0} == {-1, -2}


def test_every_text_of_a_large_lexicon_counts(spark, monkeypatch):
    model, read = truncation.context_model, []
    monkeypatch.setattr(truncation, "context_model", lambda texts: read.append(texts.where("whole").count()) or model(texts))
    df = spark.createDataFrame([(i, "free", None, "The red bus.", "The red bus.", 1, "u", "k") for i in range(5)], SCHEMA)
    lexicon = spark.range(30_000).selectExpr("concat('Number ', id, ' stops.') as text")
    assert truncation.found(df, lexicon).count() == 0 and read == [30_005]


def test_every_whole_text_is_fitted():
    texts = [f"The bus {i} stops here" + "." * (i % 2) for i in range(25_000)] + ["x", " - ", None]
    at = [len(x or "") // 2 for x in texts]
    pdf = pd.DataFrame({"text": [x or "" for x in texts], "whole": True, "alone": False, "at": at})
    got = pd.concat(truncation._counts(iter([pdf[:9_000], pdf[9_000:]])))
    assert got[got.role == "whole"].groupby("form").total.sum().to_dict() == {"closed": 12_500, "plain": 12_500}
    assert got[got.role == "cut"].total.sum() == 25_000
    tokens = got[got.role.isna()]
    assert (tokens.total.sum(), tokens.final.sum()) == (125_001, 25_001)


def test_counts_by_pieces(monkeypatch):
    # texts longer than what is held count as if read at once, and flat counts are those of a loop over tokens
    rng = random.Random(7)
    said = [text(rng, n) + rng.choice(("", " The end", " in Paris now")) for n in (1, 2, 9, 30)]
    pdf = pd.DataFrame({"text": said * 3, "whole": [True] * 4 + [False] * 8, "alone": [False] * 8 + [True] * 4, "at": 0})
    names = ["before", "kind", "word"]
    counted = lambda: pd.concat(truncation._counts(iter([pdf]))).groupby(names)[["total", "final"]].sum().astype("int64")
    at_once, want, info = counted(), {}, truncation.Tokens()
    for t, whole, alone in zip(pdf.text, pdf.whole, pdf.alone, strict=True):
        before, start, parts = "", True, t.split()
        for i, token in enumerate(parts):
            word, first, inside, end = info[token]
            kind, last = first if start else inside, i == len(parts) - 1
            if not last or whole or end or alone:
                held = want.setdefault((before, kind, word if not last or whole or end else ""), [0, 0])
                held[0] += 1
                held[1] += end or last
            before, start = kind, end
    assert {k: [*v] for k, v in zip(at_once.index, at_once.to_numpy().tolist(), strict=True)} == want
    for held in (1, 2, 3, 7):
        monkeypatch.setattr(truncation, "HELD", held)
        assert counted().equals(at_once)


def test_endings():
    info = truncation.Tokens()
    form = lambda t: truncation.form(t, truncation.inner(t).split(), info)
    assert [form(t) for t in ("A car.", '{"a": "the car', '{"a": "the car"}', "the car (red", "the car,", "One car waits. The red bus", "the car", "画面右侧", "画面右侧。")] == ["closed", "open", "closed", "hanging", "hanging", "sentence", "plain", "dense", "closed-dense"]
    assert truncation.bare_text("\u200b \xa0x\u200b\n") == "x" and truncation.stem("«L'eau»,") == "l'eau" and truncation.inner('{"t": "a b"}') == "a b"


def test_step_up_is_exact(spark):
    rng = random.Random(5)
    p = [10 ** -rng.uniform(0, 30) for _ in range(3000)] + [0.0] * 5
    small = spark.createDataFrame([(x,) for x in p if x <= truncation.FDR], "p double")
    ranked = sorted(p)
    want = max((x for k, x in enumerate(ranked, 1) if x * len(p) <= truncation.FDR * k), default=None)
    assert truncation._step_up(small, len(p)) == want
    assert truncation._step_up(small.limit(0), 10) is None
