from collections import Counter

import pytest

from frameloom.llm import pairs
from frameloom.session import read_table

PROMPT = "<image>Name the described thing in this picture in one plain phrase that fits no other thing in it."
SCHEMA = "eval_id long, source string, prompt string, reference string, prediction string, format_fail_reasons array<string>, text string, key string, copy string"


@pytest.mark.parametrize(
    "said",
    [
        PROMPT,
        PROMPT.upper(),
        "Sure! " + PROMPT[7:],
        "name the described thing in this picture in one plain phrase",
        "Name the described thing in this photo in one plain phrase that fits no other thing in it",
    ],
)
def test_copies(said):
    assert pairs.copy_ratio(PROMPT, said) <= pairs.COPY


def test_copies_of_any_length():
    for prompt in ("Name the cat.", "Say it.", "Tell me what you see."):
        assert pairs.copy_ratio(prompt, prompt.lower()) <= pairs.COPY
        for times in (2, 3, 500):
            assert pairs.copy_ratio(prompt, (prompt + " ") * times) <= pairs.COPY
        assert pairs.copy_ratio(prompt, "a red bus") > pairs.COPY
    assert pairs.copy_ratio(PROMPT, (PROMPT + " ") * 3) <= pairs.COPY and pairs.copy_ratio("", "x") == 1 and pairs.copy_ratio("?", "x") == 1


@pytest.mark.parametrize("said", ["the red car in the picture that waits beside the wall", "Name", "", "a plain thing that fits behind the other car in the inner lane", "x" * 100_000])
def test_no_copies(said):
    assert pairs.copy_ratio(PROMPT, said) > pairs.COPY


TEXTS = {
    "en": ["The white car that turns left waits beside the wall.", "A seagull sits at the plaza, and the boat passes under the bridge.", "The tractor by the sign moves on."],
    "de": ["Die alte Katze neben dem Kiosk wartet an der Haltelinie.", "Ein roter Bus fährt langsam über die Brücke.", "Das Boot liegt vor der Mauer."],
    "fr": ["La grande chèvre entre deux lampadaires accélère peu à peu.", "Un bus rouge passe lentement sur le pont.", "Le bateau attend devant le mur."],
    "es": ["La negra ciclista en el carril central espera en el semáforo.", "Un autobús rojo pasa despacio por el puente.", "El barco está delante del muro."],
}


@pytest.fixture(scope="module")
def languages(spark):
    rows = [(lang.upper() if i else f" {lang}", t) for lang, ts in TEXTS.items() for i, t in enumerate(ts * 3)] + [(None, "x y"), ("en", None), ("ru", "Красная машина")]
    return pairs.learned(spark.createDataFrame(rows, "lang string, text string"))


@pytest.mark.parametrize(
    ("said", "lang"),
    [
        ("the white car that turns left", "en"),
        ("Die Katze wartet neben der alten Mauer.", "de"),
        ("La chèvre attend entre deux lampadaires.", "fr"),
        ("La ciclista espera en el carril central.", "es"),
        ("可以看到小型的行人在天桥下方缓慢左转。", "CJK"),
        ("これは赤い猫です", "JAPANESE"),
        ("Красная машина стоит у стены", "CYRILLIC"),
        ("the seagull at the Plaza de la Ventura beside the wall", "en"),
        ("the tractor by the Straßencafé sign", "en"),
        ('{"target": "the boat under the bridge"}', "en"),
        ("[12, 13, 14]", ""),
        ("", ""),
    ],
)
def test_languages(languages, said, lang):
    assert languages.names == ["de", "en", "es", "fr"] and languages.tell(said) == lang


def test_without_labelled_texts(spark):
    assert pairs.COMMON.tell("the car that waits by the wall with the boy") == "en" and pairs.COMMON.tell("xyz") == ""
    assert pairs.learned(spark.createDataFrame([], "lang string, text string")) is pairs.COMMON


def test_every_labelled_text_and_term_counts(spark):
    # 20,000 texts, of which a sample would leave out most, and more words than a list of the most frequent ones would hold
    word = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(4))
    rows = [(("en", "de")[i % 2], f"{word(i)}x {word(i)}y {word(i)}z " * 3) for i in range(20_000)]
    known = pairs.learned(spark.createDataFrame(rows, "lang string, text string"))
    assert {f"{word(i)}{x}" for i in range(20_000) for x in "xyz"} <= set(known.packed.words)
    terms = Counter(t for _, text in rows for w in pairs.words_of(text) for t in pairs._terms(w))
    assert {t for t, n in terms.items() if n >= 2 * pairs.SEEN} <= set(known.parts)


@pytest.mark.parametrize(
    "said",
    [
        "I'm sorry, but I can't describe the people in this clip.",
        "sorry, i cannot provide an expression for this picture.",
        "As a language model I am not able to help with this request.",
        "This request cannot be fulfilled.",
        "No answer can be given for this request.",
        "Es tut mir leid, aber dabei kann ich nicht helfen.",
        "Diese Anfrage kann ich leider nicht beantworten.",
        "Je suis désolé, je ne peux pas décrire cette image.",
        "Lo siento, no puedo describir esta imagen.",
        "No me es posible responder a esta solicitud.",
        "Unfortunately it is not possible for me to comment on the marked objects.",
        "It would not be appropriate for me to answer that.",
    ],
)
def test_refusals(said):
    assert pairs.refuses(said)


@pytest.mark.parametrize(
    "said",
    [
        "a man who refuses to leave his purple barge",
        "the rust-red cyclist that cannot pass the parked trailer",
        "the driver of the olive drone, sorry-looking, around the corner",
        "the seagull with the words 'not able to stop' on its side",
        "",
    ],
)
def test_no_refusals(said):
    assert not pairs.refuses(said)


def test_defects(spark):
    good = "the red car that waits under the bridge"
    labelled = spark.createDataFrame([(lang, t) for lang, ts in TEXTS.items() for t in ts] + [("de", "Die rote Katze wartet neben dem Tor und sieht in das Wasser.")] * 3, "lang string, text string")
    rows = [
        (1, "a", PROMPT, good, good),
        (2, "a", PROMPT, good, None),
        (3, "a", PROMPT, None, good),
        (4, "a", PROMPT, " \n", "(No answer)"),
        (5, "a", PROMPT, good, "I must decline to answer that question."),
        (6, None, PROMPT, good, PROMPT.lower()),
        (7, "a", PROMPT, good, "Die alte Katze neben dem Kiosk wartet an der Haltelinie."),
        (8, "a", PROMPT, good, "The red car that waits under the"),
        (9, "a", None, good, '{"target": "the blue car under the bridge"}'),
        (10, "a", PROMPT, "Die rote Katze wartet neben dem Tor.", "La negra ciclista espera en el"),
        (7, "a", PROMPT, good, "Die alte Katze neben dem Kiosk wartet an der Haltelinie."),
        (12, "a", PROMPT, good, "Красная машина стоит у стены."),
        (11, "a", PROMPT, good, "and so the red car waits under the old bridge. " * 4000),
    ]
    got = sorted((r.eval_id, r.defect_type) for r in pairs.defects(spark.createDataFrame([(*r, None, "t", "k", "c") for r in rows], SCHEMA), labelled).collect())
    assert got == [(2, "empty"), (3, "empty"), (4, "empty"), (5, "refusal"), (6, "copy"), (7, "other_language"), (7, "other_language"), (8, "truncated"), (10, "other_language"), (10, "truncated"), (12, "other_language")]
    assert pairs.defects(spark.createDataFrame([], SCHEMA)).count() == 0


def test_real_rows(spark, data):
    kinds = {r.defect_type for r in pairs.defects(read_table(spark, data, "eval_records"), read_table(spark, data, "documents")).collect()}
    assert kinds <= {"empty", "truncated", "refusal", "copy", "other_language"}
