"""How well the URL classifier does on labelled URLs that it hasn't seen, made by a rule from other hosts than its own table's."""

from __future__ import annotations

import random

import pandas as pd
import pyarrow as pa

from lodestrata.llm import urls

BAD = "casino slots poker bets betting jackpot pills meds viagra xxx adult cams payday loans replica torrents crack warez prize winner".split()
GOOD = "news weather museum library university school garden recipes theatre history science council hospital station music travel docs wiki forum books".split()
NEUTRAL = "best my the online city green blue north world daily home first".split()


def labelled(n: int, seed: int) -> pd.DataFrame:
    """Half of each class; the telling word is in the host or in the path only, and a part has a misleading neutral word."""
    r, rows = random.Random(seed), []
    for k in range(n):
        word, other = r.choice(BAD if k % 2 else GOOD), r.choice(NEUTRAL)
        host = r.choice([f"{word}-{other}", f"{other}{word}", f"www.{word}{r.randrange(99)}", f"{other}-{r.randrange(999)}"]) + r.choice([".example", ".test", ".invalid"])
        path = r.choice([f"/{r.choice(['en', 'de', 'fr'])}/{r.randrange(9999)}", "/", f"/{other}.html"]) if word in host else f"/{word}/{r.randrange(99)}"
        rows.append((host, path, k % 2))
    return pd.DataFrame(rows, columns=["host", "path", "label"]).drop_duplicates(["host", "path"])


def accuracy(model: urls.Regression, table: pd.DataFrame) -> float:
    return float(((model.odds(pa.array(table["host"]), pa.array(table["path"])) > 0) == (table["label"] == 1)).mean())


def test_held_out_urls():
    table = labelled(900, 1)
    train, rest = table.iloc[:600], table.iloc[600:]
    found = accuracy(urls.train(train), rest)
    print("held out", found)
    assert found >= 0.95


def test_the_small_table_on_urls_of_other_hosts():
    """Half of the telling words aren't in the table: better than chance is what can be asked."""
    made = pd.DataFrame([(u.split("://", 1)[1].partition("/")[0], "/" + u.split("://", 1)[1].partition("/")[2].split("?")[0].split("#")[0], y) for u, y in urls.LABELLED], columns=["host", "path", "label"])
    found = accuracy(urls.train(made), labelled(900, 2))
    print("small table", found)
    assert found >= 0.6
