from parley.functions.words import STOP_WORDS, tokens
from parley.operators import texts


def _texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, text string")


def _tokens(spark, text):
    return _texts(spark, text).select(tokens("text").alias("t")).first()["t"]


def test_tokens(spark):
    assert _tokens(spark, "Here's a start: I'm sure they don't (sales, R&D etc).") == [
        "Here", "a", "start", "I", "sure", "they", "do", "sales", "R", "D", "etc",
    ]
    assert _tokens(spark, "B-corp 10-100 10,000 3.5 a,b x:y end...more it--is\tno\nléa über") == [
        "a", "b", "x", "y", "end", "more", "it", "is", "no", "léa", "über",
    ]
    assert _tokens(spark, "I cannot, gonna 'quoted' end.") == [
        "I", "can", "not", "gon", "na", "quoted", "end",
    ]
    assert _tokens(spark, "canna gonta Cannot") == ["canna", "gonta", "Can", "not"]
    assert _tokens(spark, "") == [] and _tokens(spark, None) is None


def test_stop_words_are_case_sensitive(spark):
    assert len(set(STOP_WORDS)) == 179
    counted = {r.token: r.n for r in texts.word_counts(_texts(spark, "The the cat. The Cat", "cat", None)).collect()}
    assert counted == {"The": 2, "cat": 2, "Cat": 1}


def test_most_frequent_tokens(spark):
    many = _texts(spark, "b b a a c", "d d d")
    assert [tuple(r) for r in texts.token_frequency(many, n=2).collect()] == [("b", 2), ("c", 1)]


def test_lemmas(spark):
    words = "thanks tried makes going went leaves running thing xs felt"
    forms = texts.word_forms(_texts(spark, words), verbs=["thank", "try", "make", "go", "leave", "run", "felt", "feel"])
    assert {r.token: r.lemma for r in forms.collect()} == {
        "thanks": "thank", "tried": "try", "makes": "make", "going": "go", "went": "go",
        "leaves": "leave", "running": "run", "thing": "thing", "xs": "xs", "felt": "felt",
    }


def test_posts_that_say_thanks(spark):
    posts = texts.thank_you_posts(
        _texts(spark, "Many Thanks, The team worked!", "thankful?", "thx", "no", None, "THANKED him")
    )
    got = {r.id: r.lemmas for r in posts.collect()}
    assert got == {
        0: ["many", "thank", "the", "team", "work"], 1: None, 2: ["thx"], 3: None, 4: None, 5: ["thank"],
    }


def test_stems_out_of_a_table(spark, rows):
    words = texts.word_counts(_texts(spark, "rituals values rituals"))
    table = spark.createDataFrame([("rituals", "ritual"), ("other", "oth")], "token string, stem string")
    assert rows(texts.forms_from_table(words, table, "stem")) == [("rituals", 2, "ritual"), ("values", 1, "values")]
