"""A seeded passenger table for tests."""

import random

from cohortwise.sources.tables import PASSENGER_SCHEMA

TITLES = {"male": ["Mr", "Mr", "Mr", "Master", "Dr", "Rev"], "female": ["Miss", "Mrs", "Mlle", "Ms"]}
LETTERS = "abcdefghij"


def passengers(spark, n=240, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(1, n + 1):
        sex = rng.choice(["male", "female"])
        klass = rng.choice([1, 2, 3, 3])
        family = "Fam" + "".join(LETTERS[int(d)] for d in str(rng.randrange(60)))
        title = rng.choice(TITLES[sex])
        lives = rng.random() < (0.8 if sex == "female" else 0.2)
        rows.append(
            (
                i, int(lives), klass, f"{family}, {title}. Given {i}", sex,
                None if i % 7 == 0 else float(rng.randrange(1, 80)),
                rng.randrange(3), rng.randrange(3),
                rng.choice([f"A/5 {i}", f"PC {i}", str(i), "LINE"]),
                None if i % 41 == 0 else round(rng.uniform(5, 300) / klass, 2),
                rng.choice([None, None, f"C{i}", "B57 B59"]),
                None if i % 50 == 0 else rng.choice("CQS"),
            )
        )
    return spark.createDataFrame(rows, PASSENGER_SCHEMA)
