"""Small tables with what operators must bear: nulls, empty and long texts, ties, repeated rows."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, shard int"

_SYLLABLES = {
    "en": ["the", "ing", "er", "on", "and", "tion", "es", "re"],
    "de": ["sch", "ung", "ein", "der", "keit", "ü", "ver", "ß"],
    "fr": ["eau", "que", "é", "les", "ment", "ou", "ç", "aire"],
}


def prose(rng, lang, words):
    parts = _SYLLABLES[lang]
    made = ["".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(words)]
    return " ".join(word + rng.choice(["", "", "", ".", ",", ".\n"]) for word in made)


def document(doc_id, text, lang="en"):
    size = None if text is None else len(text)
    return (doc_id, text, lang, "src", size, 0.5, False, 3)


def some_documents(seed=1, count=120):
    rng = random.Random(seed)
    rows = []
    for number in range(count):
        lang = rng.choice(["en", "en", "de", "fr"])
        rows.append(document(number, prose(rng, lang, rng.randint(1, 120)), lang))
    return rows


def odd_documents():
    """Null ids, texts and languages, repeated rows and ids, texts of white space, one very long."""
    rng = random.Random(7)
    long = prose(rng, "en", 30_000)
    return [
        document(1000, None), document(1001, ""), document(1002, " \t\n "), document(1003, "..."),
        document(1004, long), document(1005, long), document(None, "the ring and the other one", "en"),
        document(1006, "only four words here", None), document(1006, "only four words here", None),
        document(1007, "one id, two texts"), document(1007, "and the other text of it"),
        document(None, None, None), document(1008, "Áb <|endoftext|> \x1c c d İ"),
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)
