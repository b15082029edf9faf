import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHES = "ids long, key long, at long, band long, registers string, _id long, _gone boolean, _cuts string, _bad long, home long, window_id long, n_tokens long, reason string, toxic int, quality int, embedding string"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(["the", "an", "re", "ti", "on", "er", "ou", "sh", "ble"]) for _ in range(r.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Plain, near and exact copies, a shared passage, a very long text, empties, blanks, odd letters."""
    shared = prose(900, 60)
    base = {i: prose(i, 80 + 7 * i) for i in range(20)}
    base[20] = base[3]
    words = base[5].split()
    words[10], words[60] = "changed", "altered"
    base[21] = " ".join(words)
    base[22] = prose(50, 30) + " " + shared + " " + prose(51, 30)
    base[23] = prose(52, 40) + "\n" + shared + "\n" + prose(53, 20)
    base[24] = prose(54, 60_000)
    base[25] = ""
    base[26] = " \n\t "
    base[27] = "één ñandú 中文 😀 'tis we'll   end "
    base[28] = "again " * 300
    base[29] = 'token = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b" ' + prose(55, 40)
    base[30] = "short"
    return base


@pytest.fixture(scope="session")
def rows(texts):
    """As rows: also a null text, null ids, null language, and a repeated row."""
    out = [(i, t, ["en", "fr", "de", "es"][i % 4], f"src{i % 3}", len(t)) for i, t in texts.items()]
    return [*out, (31, None, "en", "src0", None), (None, prose(60, 90), "en", None, 5), (None, prose(3, 101), None, "src1", None), (32, prose(61, 70), None, None, None), out[7], out[7]]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark, rows):
    extra = len(CLASHES.split(", "))
    return spark.createDataFrame([(*r, *([None] * extra)) for r in rows], f"{SCHEMA}, {CLASHES}")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_dir(spark, docs, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 7 == 0)) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d
