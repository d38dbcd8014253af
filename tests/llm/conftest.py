import random

import pytest

SYLLABLES = "an the ou re ing tion est ver hea lor mit sum dol cen par vel qui nos tra fen".split()


def words(rng, n):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def make_rows(seed=1):
    """Documents with nulls, blanks, ties, copies, near copies, shared lines and a very long text."""
    rng = random.Random(seed)
    shared = [" ".join(words(rng, 14)) for _ in range(4)]
    rows = []
    for k in range(60):
        lines = [" ".join(words(rng, rng.randint(1, 30))).capitalize() + "." for _ in range(rng.randint(1, 6))]
        if k % 5 == 0:
            lines.insert(1, rng.choice(shared))
        if k % 7 == 0:  # a shared line with one word changed, dropped or added
            w = rng.choice(shared).split()
            at = rng.randrange(len(w))
            w[at:at + 1] = rng.choice([["changed"], [], [w[at], "more"]])
            lines.append(" ".join(w))
        rows.append((k * 3, "\n".join(lines), f"src{k % 4}"))
    for k in range(12):  # copies and near copies
        base = rows[k]
        rows.append((500 + k, base[1], base[2]))
        rows.append((600 + k, base[1].replace("an", "am", 1) + " end", "src1"))
    rows += [(700, None, "src0"), (701, "", None), (702, " \t\n ", "src2"), (703, "One", None), (704, "two words", "z"),
             (None, "a text without an id\nand a second line of it here", "src1"), (None, None, None),
             (705, rows[0][1].replace(" ", "  \t"), "src3"), (706, " ".join(words(rng, 20000)), "src0"),
             (707, "Released under the MIT License.\nMIT\nlicense", "src0"),
             (708, "GNU General Public License and Apache-License, cc, by", "src0")]
    rows += rows[3:5]  # repeated rows
    return rows


CLASHES = ["id", "row", "size", "fp", "bucket", "part", "gone", "rank", "key"]


@pytest.fixture(scope="session")
def doc_rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    full = [(i, t, "en", s, len(t or ""), *[f"x{i}"] * len(CLASHES)) for i, t, s in doc_rows]
    schema = ("doc_id long, text string, lang string, source string, n_chars long, "
              + ", ".join(f"`{c}` string" for c in CLASHES))
    return spark.createDataFrame(full, schema).repartition(5, "lang", "doc_id")


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
