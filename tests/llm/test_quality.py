import base64
import random

import numpy as np
import pytest

from tests.conftest import rows
from tidemark.llm.quality import COLUMNS, PROFILES, Lexicon, Quality, function_counts, jensen_shannon, layout, text_quality

WORDS = [("en", w) for w in "the of and a to in is was that it for on with as had we by not be this were from but".split()] + [("de", w) for w in "der die das und nicht ist war wurde wir den mit auf".split()] + [("zh", w) for w in "的 了 不 也".split()]
PROSE = "The river had risen in the night and the bridge was closed. We waited for the boat that was to bring us over, but it was late and it was cold."
GERMAN = "Der Fluss war in der Nacht gestiegen und die Brücke wurde gesperrt. Wir haben auf das Boot gewartet, das uns nicht mehr holen konnte."
CHINESE = "昨天晚上河水涨了，桥也不通了。我们在等的船来得很晚，天也冷了。"


@pytest.fixture(scope="module")
def quality():
    return Quality(WORDS)


def structures(q, *texts):
    return q.measure(list(texts))["structure"]


@pytest.mark.parametrize("text", [PROSE, GERMAN, CHINESE, PROSE.upper(), PROSE.lower().replace(".", "").replace(",", ""), PROSE.replace(" ", "\n", 3), "> " + PROSE, "# Title here\n\n" + PROSE, f"<p>{PROSE}</p>", "Q: " + PROSE, "\n".join(PROSE[i : i + 45] for i in range(0, len(PROSE), 45)), "In 1998 the 345 boats of the 12 towns were sold for 78.5 percent of the price that was asked in 1997."])
def test_prose_is_prose(quality, text):
    assert structures(quality, text) == ["prose"]
    assert quality.measure([text])["not_prose"] == [False]


r = random.Random(1)
NOT = {
    "bullets": "\n".join(f"* {w} lamp, steel" for w in "red blue green black white pink".split()),
    "numbered": "\n".join(f"{i}) how to read the map of a town" for i in range(6)),
    "checked": "\n".join(f"- [x] what is in the box {i}" for i in range(6)),
    "row": "red lamp · blue chair · green table · black stool · white shelf · pink rug",
    "commas": ", ".join(f"{w} lamp" for w in "red blue green black white pink grey gold".split()),
    "leaders": "\n".join(f"the chapter of the sea ........ {i}" for i in range(5)),
    "bare entries": "red lamp\nblue chair\nwhat is in the box\ngreen table\nblack stool",
    "tabs": "\n".join("\t".join(str(r.randrange(999)) for _ in range(4)) for _ in range(6)),
    "commas without spaces": "\n".join(",".join(["a", "12", "x7", "lamp"]) for _ in range(6)),
    "pipes": "| a | b |\n| --- | --- |\n" + "\n".join("| lamp | 12 |" for _ in range(6)),
    "aligned": "\n".join("lamp      steel     12" for _ in range(6)),
    "frame": "\n".join(["+-----+-----+", "| a   | 12  |"] * 4),
    "html": "<table><tr><td>lamp</td><td>12</td></tr>\n<tr><td>chair</td><td>13</td></tr></table>",
    "log": "\n".join(f"2025-01-0{i} 10:00:00,123 INFO [task-1] size={i} of=lamp" for i in range(1, 7)),
    "objects": "\n".join(f'{{"name": "lamp", "price": "{i}"}}' for i in range(6)),
    "numbers": " ".join(str(r.randrange(10**7)) for _ in range(60)),
    "hex": "\n".join("%048x" % r.getrandbits(192) for _ in range(5)),
    "encoded": base64.b64encode(bytes(r.randrange(256) for _ in range(400))).decode(),
    "letters": " ".join("".join(r.choice("bcdfghjklmnpqrstvwxz") for _ in range(r.randrange(4, 10))) for _ in range(40)),
    "words": " ".join(r.choice(["lamp", "chair", "table", "steel", "price", "offer"]) for _ in range(60)),
    "wrong decoding": CHINESE.encode().decode("latin-1"),
    "pictures": "".join(r.choice("🎉🔥👍🚀😂✅⭐💥") for _ in range(60)),
    "symbols": "\n".join("".join(r.choice("#$%&*+/<=>@[]^_{|}~") for _ in range(30)) for _ in range(4)),
    "repeated sentence": "The lamp was late and it was cold. " * 12,
    "repeated words": "the box of the lamp " * 30,
}


@pytest.mark.parametrize("name", sorted(NOT))
def test_what_is_no_prose(quality, name):
    assert quality.measure([NOT[name]])["not_prose"] == [True], quality.measure([NOT[name]])


def test_the_larger_part_decides(quality):
    table = NOT["tabs"]
    long = (PROSE + "\n") * 3 + GERMAN + "\n"
    assert structures(quality, long + table) == ["prose"]
    assert structures(quality, PROSE.split(".")[0] + ".\n" + "\n".join([table] * 6)) == ["table"]


def test_nothing(quality):
    got = quality.measure([None, "", " \t\n", "​"])
    assert got["not_prose"][:3] == [False] * 3 and got["profile"][:3] == ["empty"] * 3
    assert got["n_words"][:3] == [0, 0, 0]
    assert quality.measure([]) == {n: [] for n, _ in COLUMNS}


def test_counts(quality):
    got = quality.measure(["The lamp was red.\nIt was not of steel"])
    assert (got["n_words"], got["punctuated_lines"], got["language"]) == ([9], [0.5], ["en"])
    assert got["common_words"][0] == pytest.approx(6 / 9)
    assert got["mean_word_length"][0] == pytest.approx(sum(map(len, "The lamp was red It was not of steel".split())) / 9)
    assert quality.measure([GERMAN])["language"] == ["de"] and quality.measure([CHINESE])["language"] == ["zh"]


def test_long_texts_are_read_whole(quality):
    got = quality.measure([(PROSE + " ") * 800 + NOT["numbers"] * 600])
    assert got["n_words"][0] > 20_000 and got["characters"][0] > 100_000 and got["not_prose"] == [True]


def test_divergence():
    p = np.array([[1.0, 0, 0], [0.5, 0.5, 0]])
    q = np.array([[0, 1.0, 0], [0.5, 0.5, 0], [0, 0, 1]])
    d = jensen_shannon(p, q)
    assert d[0, 0] == pytest.approx(1) and d[1, 1] == 0 and d[0, 2] == pytest.approx(1) and 0 < d[1, 0] < 1
    assert {p[0] for p in PROFILES.values()} == {"prose", "list", "table", "machine", "junk"}


def test_a_word_is_not_a_bullet_where_it_is_a_word():
    assert layout("o preço do artigo mudou", letter_o=False) == 0
    assert layout("o red lamp", letter_o=True) == 1


def test_on_spark(spark):
    df = spark.createDataFrame([(1, PROSE, "x"), (1, NOT["bullets"], "x"), (None, None, "x"), (3, NOT["hex"], "x")], "doc_id bigint, text string, profile string")
    words = spark.createDataFrame([*WORDS, (None, "x"), ("en", None)], "lang string, word string")
    assert rows(text_quality(df, words), "doc_id", "structure", "not_prose") == sorted([(1, "prose", False), (1, "list", True), (None, "empty", False), (3, "junk", True)], key=str)
    assert text_quality(df.limit(0), words).count() == 0
    assert text_quality(df, words.limit(0)).count() == 4


def test_long_runs_of_letters_count_whole(quality):
    got = quality.measure(["a" * 10_000 + ".", "b" * 1_100_000 + " cc"])
    assert got["mean_word_length"] == [10_000, 550_001]


FOUR = "The grey heron stood in shallow water near our landing. Several children carried baskets full of apples toward market. My uncle repaired wooden boats during every long winter evening. Nobody remembered who had painted those blue doors upstairs. "
OTHER = "When spring came they opened another shop beside the station. Her brother wrote letters about mountains, glaciers and strange flowers. A teacher from Norway explained why bridges sometimes freeze before roads. It seemed that most visitors preferred quiet gardens. "


@pytest.mark.parametrize("text", [(PROSE + " " + OTHER) * 8, FOUR * 8, FOUR.replace(".", "") * 8, OTHER + "The lamp was late and it was cold. " * 20, "".join(f"The lamp was late and it was cold. {x}. " for x in OTHER.split(". ")) * 1 + "The lamp was late and it was cold. " * 12])
def test_fragments_repeated_in_more_than_half(quality, text):
    got = quality.measure([text])
    assert got["not_prose"] == [True] and got["structure"] == ["junk"]


def test_fragments_repeated_in_less_than_half(quality):
    got = quality.measure([OTHER + FOUR + "The lamp was late and it was cold. " * 6, OTHER + FOUR])
    assert got["not_prose"] == [False, False] and 0.5 < got["prose_share"][0] < 0.8 and got["prose_share"][1] == 1


def test_profiles_are_counted_over_all_documents(spark):
    words = [("en", "the"), ("en", "of"), ("en", "and"), ("de", "der"), ("de", "und")]
    df = spark.createDataFrame([(1, "the cat and the dog of the house"), (2, "der Hund und der Mann"), (3, None), (4, ""), (5, "the the")], "doc_id bigint, text string")
    got = function_counts(df.repartition(3), words)
    assert {k: n for k, n in got.items() if k[0] in ("en", "de")} == {("en", "the"): 5, ("en", "and"): 1, ("en", "of"): 1, ("de", "der"): 2, ("de", "und"): 1}
    x = Lexicon(words, got)
    assert x.profiles[x.languages.index("en"), x.index["the"]] > x.profiles[x.languages.index("en"), x.index["of"]] and abs(x.profiles.sum(1) - 1).max() < 1e-9
    near, none = np.zeros(len(x.index)), np.zeros(len(x.index))
    near[x.index["the"]] = 3
    assert x.far(near, "en") < x.far(near, "de") and x.far(none, "en") == 1.0


def test_a_short_sentence_of_few_function_words_is_prose(spark):
    words = [("fr", w) for w in "le la les de des et est un une pour dans cette".split()]
    df = spark.createDataFrame([(i, "Personne ne savait à qui appartenait cette table.") for i in range(3)] + [(9, "Le chat est dans la maison et les enfants de la ville jouent dans le jardin.")], "doc_id bigint, text string")
    got = text_quality(df, spark.createDataFrame(words, "lang string, word string"))
    assert got.where("not_prose").count() == 0
