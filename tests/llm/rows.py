"""Small awkward tables: NULLs, empty and long texts, ties, repeated rows, columns whose names clash with inner ones."""

import random

random.seed(7)
WORDS = ["the", "of", "and", "Haus", "mañana", "élan", "x#y", "|", "A!", "river", "is", "in"]


def prose(n):
    return " ".join(random.choice(WORDS) for _ in range(n))


PASSAGE = prose(60)
TEXTS = [
    None, "", "   ", "\n\n", "one", "one two", "one two three four", prose(30), prose(400), prose(20_000), "a" * 5000,
    "same line\nsame line\nsame line", "Der " * 50, prose(10) + "\n" + PASSAGE + "\n" + prose(10), PASSAGE, PASSAGE + " tail",
    "\x1c\x1dodd \x85 spaces here ", "Σίσυφος ΣΑΣ İstanbul", "<|endoftext|> mid <|startoftext|>", "🎉 é é 日本語 12345",
    "He's we'll don't I'M", "THE LOUD TEXT IS HERE!! " * 6, prose(25) + "\r\n" + prose(5),
]
# doc_id, text, lang, source, then names that operators use inside
AWKWARD = [(i, t, ["en", "de", None][i % 3], ["a", "b", None, "ü"][i % 4], i, "x", 1, "y", 2, 3, "z")
           for i, t in enumerate(TEXTS)]
AWKWARD += [AWKWARD[8]] * 3 + [AWKWARD[13]]  # repeated rows
AWKWARD += [(None, prose(30), "en", "a", 0, "x", 1, "y", 2, 3, "z"), (None, None, None, None, None, None, None, None, None, None, None),
            (100, TEXTS[8], "en", "a", 0, "x", 1, "y", 2, 3, "z"), (101, TEXTS[8], "de", "b", 0, "x", 1, "y", 2, 3, "z"),
            (101, prose(40), "de", "b", 0, "x", 1, "y", 2, 3, "z")]
SCHEMA = ("doc_id long, text string, lang string, source string, size long, id string, bucket int, ids string, copies long, "
          "fp long, row string")


def frame(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA).repartition(3)


def sf_documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
