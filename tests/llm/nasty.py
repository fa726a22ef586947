"""Small tables with the cases that every operator has to bear."""

import random

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "id long, fp long, word string, kept boolean, block long, split long")
SYLLABLES = "an the re ing tion ed er on is of ha le qu es en".split()


def words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


def texts():
    """doc_id to text; some texts are copies, near copies, empty, NULL or very long."""
    base = words(1, 300)
    found = {i: words(i, 40 + 7 * i) for i in range(10, 30)}
    found |= {1: base, 2: base, 3: base.replace(" the ", " an ", 1), 4: None, 5: "", 6: " \t\n ",
              7: "one", 8: "two words", 9: words(9, 20_000), 40: "line of five words here\n" * 12,
              41: "é ü ß 中文 \U0001F600 ▁ <|end|> \\ %0D", 42: "1234 5678 !!", 43: "x" * 30_000,
              44: "$$$ ### " + words(44, 50).replace(" ", "### ")}
    return found


def docs(spark):
    """The texts with NULLs in all columns, a repeated row, and columns named like ours."""
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None, None, 7, i, "word", None, 1, 2)
            for i, t in texts().items()]
    rows += [rows[0], (None, words(77, 60), "en", "s1", 3, None, None, None, True, None, None),
             (None, None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return docs(spark).where("false")


def by_id(df, key="doc_id"):
    return {row[key]: row for row in df.collect()}
