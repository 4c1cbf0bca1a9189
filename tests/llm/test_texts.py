"""Line windows, decontamination, packing, sharding and secrets against plain-Python versions."""

import hashlib
import math
import random
import struct
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

import __spark_entry__
from contrail.llm import decontamination, line_windows, packing, secrets, sharding

from .helpers import SMALL, base_secrets, documents


def _rows(texts):
    return [(i, t, None, None, None) for i, t in enumerate(texts)]


# ---------------------------------------------------------------- line windows

def _dedupe(texts):
    seen, out = set(), []
    for text in texts:
        lines = (text or "").split("\n")
        solid = [i for i, x in enumerate(lines) if x.strip(" \t\r\x0b\x0c")]
        gone = set()
        for a, b, c in zip(solid, solid[1:], solid[2:]):
            key = tuple(lines[i].strip(" \t\r\x0b\x0c") for i in (a, b, c))
            if key in seen:
                gone |= {a, b, c}
            seen.add(key)
        out.append("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text)
    return out


def test_line_windows_against_brute_force(spark):
    rnd = random.Random(4)
    texts = ["\n".join(rnd.choice(["a", "b", " a ", "", "c\r", "dé"]) for _ in range(rnd.randint(0, 25))) for _ in range(60)]
    texts += [None, "", "a\nb", "x\ny\nz", "x\ny\nz", "x\ny\nz\nw", "q\n" * 30]
    got = line_windows.dedupe_lines(documents(spark, _rows(texts))).orderBy("doc_id").collect()
    assert [r.text for r in got] == _dedupe(texts)


def test_every_line_stays_somewhere(spark):
    rnd = random.Random(9)
    texts = ["\n".join(rnd.choice("abcd") for _ in range(rnd.randint(3, 20))) for _ in range(40)]
    got = line_windows.dedupe_lines(documents(spark, _rows(texts))).collect()
    assert {x for t in texts for x in t.split("\n")} <= {x for r in got for x in (r.text or "").split("\n")}


def test_hot_and_cold_keys_agree(spark, monkeypatch):
    texts = ["a\nb\nc\nd"] * 20 + ["c\nd\ne\nf", "d\ne\nf"] + ["k\nl\nm"]
    want = _dedupe(texts)
    for rows in (1, 10_000):
        monkeypatch.setattr(line_windows, "HOT_ROWS", rows)
        got = line_windows.dedupe_lines(documents(spark, _rows(texts))).orderBy("doc_id").collect()
        assert [r.text for r in got] == want


def test_line_windows_oracle(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = duckdb.sql(__spark_entry__.oracle_sql()["op2_line_windows"]).df()
    got = line_windows.op2_line_windows(spark, SMALL).toPandas()
    cols = sorted(want.columns)
    assert sorted(got[cols].itertuples(index=False, name=None)) == sorted(want[cols].itertuples(index=False, name=None))


# ---------------------------------------------------------------- decontamination

ITEM = "Anna has 5 apples and walks 12 km to the old market where Robert sells them for 3 dollars each."


def _found(spark, texts, items=(ITEM,)):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = decontamination.contaminated(documents(spark, _rows(texts)), bench).collect()
    return {(r.doc_id, r.item_id): r for r in rows}


def test_plain_and_reparameterised_copies(spark):
    other = ITEM.replace("5", "41").replace("12 km", "7 miles").replace("Robert", "Walter").replace("3 dollars", "2 euros")
    texts = [ITEM, "Intro words first. " + other + " More follows.", "Nothing of the kind stands in this text at all, I say.",
             ITEM.upper(), " ".join(ITEM.split()[:9])]
    got = _found(spark, texts)
    assert set(got) == {(0, 0), (1, 0), (3, 0)}
    assert not got[0, 0].reparameterised and got[1, 0].reparameterised


def test_slots_must_be_consistent(spark):
    item = "Start with 5 stones then add 5 stones and take 5 stones until just 5 stones are left over there."
    same = item.replace("5", "9")
    mixed = item.replace("5", "9", 2).replace("5", "8", 1)
    names = "We saw Peter with Maria near the lake and Peter gave Maria the red book of old songs."
    swapped = names.replace("Peter", "Paul").replace("Maria", "Nina")
    merged = names.replace("Peter", "Paul").replace("Maria", "Paul")
    got = _found(spark, [same, mixed, swapped, merged], [item, names])
    assert set(got) == {(0, 0), (2, 1)}


def test_decontamination_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    got = {(r.doc_id, r.item_id) for r in decontamination.op3_template_decontamination(spark, SMALL).collect()}

    def bare(text):
        return [w.strip(".,").lower() for w in text.split()]
    want = set()
    for d in docs:
        have = bare(d.text)
        grams = {tuple(have[i:i + 8]) for i in range(len(have) - 7)}
        for b in bench:
            item = bare(b.text)
            hit = {i + j for i in range(len(item) - 7) if tuple(item[i:i + 8]) in grams for j in range(8)}
            if len(hit) >= 0.7 * len(item):
                want.add((d.doc_id, b.item_id))
    assert want and got == want


def test_names_that_open_sentences(spark):
    item = "Tom has 5 apples. Tom gives 2 to Sue. Sue eats them all. Tom then buys some more."
    other = item.replace("Tom", "Ann").replace("Sue", "Bob").replace("5", "7").replace("2", "3")
    short = "Oliver painted seven wooden chairs"
    got = _found(spark, [item, other, "He asked, as so often before: " + short, "so " + item.replace("Tom has", "tom has")],
                 [item, short])
    assert set(got) == {(0, 0), (1, 0), (2, 1), (3, 0)} and got[1, 0].reparameterised


def test_other_names_and_written_numbers(spark):
    item = "We think that Thompson walked 12 miles to the old market and gave away 5 loaves there."
    names = ["McDonald", "O'Neil", "USA", "Jean-Luc", "Mary Ann"]
    texts = [item.replace("Thompson", n) for n in names]
    texts += [item.replace("12", "twelve").replace("5", "five"), item.replace("12", "twenty-one")]
    assert set(_found(spark, texts, [item])) == {(k, 0) for k in range(len(texts))}


def test_short_items_are_found_word_for_word(spark):
    texts = ["He asked: what is love? Nobody knew.", "What is lost", "Paris", "To Paris and back", "new york!", "love is what"]
    got = _found(spark, texts, ["What is love", "Paris", "New York", ""])
    assert set(got) == {(0, 0), (2, 1), (4, 2)} and all(r.coverage == 1 for r in got.values())


def test_bitmap_holds_every_window(spark):
    items = spark.range(5000).selectExpr("xxhash64(id) AS hash")
    bits = decontamination._bitmap(items)
    hashes = np.array([r.hash for r in items.collect()]).view(np.uint64)
    n = (8 * len(bits)).bit_length() - 1
    assert decontamination._has(bits, hashes >> np.uint64(64 - n)).all()
    assert decontamination._has(bits, hashes & np.uint64(2**n - 1)).all()
    assert np.unpackbits(bits).sum() <= 2 * len(hashes)


def test_items_with_few_plain_words(spark):
    item = "12 + 7 = 19 and 30 km 4 kg Paris Rome Berlin 8 9 10 11 Oslo 5 6 7 cm"
    got = _found(spark, ["Look: " + item + " and so on.", item.replace("19", "21").replace("Rome", "Bern").replace("9", "3")],
                 [item])
    assert set(got) == {(0, 0)} and got[0, 0].coverage == 1


def test_a_contradicting_slot_drops_its_windows_only(spark):
    rest = " ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(56))
    item = "there are 5 " + rest + " until 5 remain"
    got = _found(spark, [item.replace("until 5", "until 6"), item.replace("are 5", "are 8").replace("until 5", "until 9")],
                 [item])
    assert set(got) == {(0, 0), (1, 0)} and got[0, 0].coverage < 1


# ---------------------------------------------------------------- packing

def test_encoder_equals_the_library():
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    enc = packing.Encoder(cache_pieces=50)
    rnd = random.Random(8)
    alphabet = ["a", "B", "é", " ", "  ", "\n", "\n\n", "\t", "'s", "12", ".", " ", " ", "\x1c", "\U0001f600",
                "hello", "ſ", "\r\n", "<|endoftext|>", "the ", "-", "中"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    texts += ["", " ", "\n", "a b", " a", "a ", "a\nb c\nd", "don't we'll", "x" * 3000]
    for t in texts:
        assert np.frombuffer(enc(t), "<u2").tolist() == exact.encode(t, add_special_tokens=False).ids, repr(t)


def test_packing_round_trip(spark):
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(7)
    ids = {r.doc_id: exact.encode(r.text, add_special_tokens=False).ids + [1] for r in docs.collect()}
    pieces = packing.pack(docs, window=512).collect()
    at = Counter()
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        assert p.start == at[p.doc_id] and p.doc_tokens == len(ids[p.doc_id])
        part = np.array(ids[p.doc_id][p.start:p.start + p.length], "<u4")
        assert zlib.crc32(part.tobytes()) == p.ids_crc32
        at[p.doc_id] += p.length
    assert at == {d: len(x) for d, x in ids.items()}
    used = Counter()
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == used[p.sequence_id]
        used[p.sequence_id] += p.length
    last = max(used)
    assert sorted(used) == list(range(last + 1)) and all(used[s] == 512 for s in range(last)) and used[last] <= 512


# ---------------------------------------------------------------- sharding

def test_sharding_moves_rows_only_into_the_new_shard(spark):
    df = spark.range(4000).withColumnRenamed("id", "doc_id")
    rows = sharding.shard_rows(df, "doc_id", [1.0] * 10, grown_weight=1.0, n_buckets=5).collect()
    assert all(r.grown_shard in (r.shard, 10) for r in rows)
    assert 250 < sum(r.grown_shard == 10 for r in rows) < 500
    eleven = {r.doc_id: r.shard for r in sharding.shard_rows(df, "doc_id", [1.0] * 11).collect()}
    assert eleven == {r.doc_id: r.grown_shard for r in rows}
    for s in range(10):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_winning_shard_recomputed(spark):
    """Every draw by hand: XXH64 of the id, then of the shard, the lowest -log(u) / weight wins."""
    def winner(key, weights):
        costs = []
        for shard, w in enumerate(weights):
            seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
            u = ((xxhash.xxh64_intdigest(struct.pack("<i", shard), seed) >> 11) + 0.5) / 2**53
            costs.append((-math.log(u) / w, shard))
        return min(costs)[1]

    keys = [None, 0, -5, 2**62, *range(1, 400)]
    df = spark.createDataFrame([(k,) for k in keys], "doc_id long")
    for weights in ([1.0] * 40, [1.0, 2.0, 0.5], [3.0]):
        got = sharding.shard_rows(df, "doc_id", weights, grown_weight=2.0).collect()
        assert all(r.shard == winner(r.doc_id, weights) and r.grown_shard == winner(r.doc_id, [*weights, 2.0]) for r in got)


def test_a_hot_key_fills_all_buckets_of_its_shard(spark):
    rows = [(7, i) for i in range(3000)] + [(None, i) for i in range(1000)] + [(i, 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, x long")
    out = sharding.shard_rows(df, "doc_id", [1.0] * 4, n_buckets=10)
    got = out.collect()
    for s in range(4):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    hot = sorted(r.slot // 200 for r in got if r.doc_id == 7)
    assert len(set(hot)) > 10  # all over its shard, not in one run of a bucket


def test_sharding_follows_the_weights(spark):
    df = spark.range(8000).withColumnRenamed("id", "doc_id")
    n = Counter(r.shard for r in sharding.shard_rows(df, "doc_id", [1.0, 2.0, 5.0]).collect())
    assert abs(n[0] / 8000 - 1 / 8) < 0.02 and abs(n[1] / 8000 - 2 / 8) < 0.02 and abs(n[2] / 8000 - 5 / 8) < 0.02
    # a shard's draw does not depend on the others: taking one away moves its rows only
    three = {r.doc_id: r.shard for r in sharding.shard_rows(df, "doc_id", [1.0, 2.0, 5.0]).collect()}
    two = {r.doc_id: r.shard for r in sharding.shard_rows(df, "doc_id", [1.0, 2.0]).collect()}
    assert all(two[d] == s for d, s in three.items() if s < 2)


def test_op8_digests(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = sharding.op8_rendezvous_sharding(spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.size == len(docs[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(docs[r.doc_id].encode())
               and 0 <= r.shard < 40 and r.law == "key" for r in rows)


# ---------------------------------------------------------------- secrets

def test_base_spans_against_patterns(spark):
    rnd = random.Random(6)
    bits = ["password", "=", ":", " ", "  ", '"', "'", "token", "API_KEY", "apikey", "sEcReT", "abc123XYZ", "AKIA", "QWERTY12",
            "deadbeef" * 3, "0f", "é", "\n", "passwd", "ſ", "K", "x", "\U0001f600", "==", "/+_.-"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30))) for _ in range(800)]
    texts += ["password=token: abcdefgh", "AKIA" * 6, "", None]
    got = {r.doc_id: r.spans for r in secrets.scan(documents(spark, _rows(texts))).collect()}
    for i, t in enumerate(texts):
        assert [f"{s.kind}:{s.start}:{s.end}" for s in got[i] if s.kind != "lexed"] == base_secrets(t), repr(t)


def test_op6_digest(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in secrets.op6_assignment_secrets(spark, SMALL).collect():
        spans = base_secrets(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in spans) for k in ("assign", "access", "hex"))


def _lexed(text):
    return [text[a:b] for kind, a, b, _ in secrets.find(text) if kind == "lexed"]


def test_lexer_pairs_and_constants():
    assert _lexed('db_password = "hunter2-xyz"') == ["hunter2-xyz"]
    assert _lexed('{"client_secret": "QWxhZGRpbjpv", "port": "8080808080"}') == ["QWxhZGRpbjpv"]
    assert _lexed("config['api_key'] = 'sk_live_9f8g7h6j5k'") == ["sk_live_9f8g7h6j5k"]
    assert _lexed('os.environ.get("API_TOKEN", "tok-88ab77zz")') == ["tok-88ab77zz"]
    assert _lexed("<password>h4nter2xx!</password>") == ["h4nter2xx!"]
    assert _lexed("--auth-token=zx81-9922-kk7") == ["zx81-9922-kk7"]
    # constants, also through another name and joined
    assert _lexed('part = "abc123XYZ"\nwhole = part + "def456"\nsigning_key_token = whole') == ["abc123XYZ", "def456"]
    # harmless targets and values
    for text in ('password = "changeme"', 'password_length = "123456789a"', 'title = "abc123XYZ987"', "token: see below",
                 'password = "${DB_PASSWORD}"', "the secret: something nice", 'greeting = "hello hello"'):
        assert _lexed(text) == [], text


def test_lexer_is_linear_on_long_lines():
    text = "x='" * 40_000 + " password = " + "a1b2c3d4" * 20_000
    assert secrets.find(text)


def test_lexer_right_sides():
    value = "sk9-aQ7zz81Kp"
    for text in (f'api_key: str = "{value}"', f'let api_secret: &str = "{value}";', f'db_password = b"{value}"',
                 f'db_password = ("{value}")', f'auth_token = Secret("{value}")', f'db_password = (\n    "{value}"\n)',
                 f'db_password = \\\n    "{value}"', f'db_password = """{value}"""', f'client_secret: |\n  {value}\nport: 1',
                 f'client_secret:\n  "{value}"\n', f'api_token: dict[str, str] = "{value}"'):
        assert _lexed(text) == [value], text
    assert _lexed(f'auth_token = (\n  "{value}"\n  "b2c3d4e5f6"\n)') == [value, "b2c3d4e5f6"]
    for text in ('password = os.getenv("DB_PASSWORD_1")', 'client_secret:\n  name9x8y7z: 1', 'password = """unclosed'):
        assert _lexed(text) == [], text


def test_lexer_keeps_every_term_of_a_long_join():
    parts = [f"a1b2c3d4-{i:04}" for i in range(200)]
    assert _lexed("password = " + " + ".join(f'"{p}"' for p in parts)) == parts
    chain = 'k0 = "a1b2c3d4-0000"\n' + "".join(f'k{i} = k{i - 1} + "{parts[i]}"\n' for i in range(1, 200)) + "password = k199"
    assert _lexed(chain) == parts


def test_joined_values_are_scored_whole():
    assert _lexed('api_key = "Zx9k" + "k22Q" + "p99a"') == ["Zx9k", "k22Q", "p99a"]
    assert _lexed('a = "Zx9k"; b = a + "k22Qp"; secret_val = b') == ["Zx9k", "k22Qp"]
    assert _lexed('password = ("Zx9!" "kk22" "Qp7?")') == ["Zx9!", "kk22", "Qp7?"]
    assert _lexed('keys = ["Zx9k", "k22Q", "p99a"]') == []  # values of their own
    assert _lexed('api_key = "aa" + "aa" + "aa"') == []
    chain = 'v0 = "Zx9kk22Q"\n' + "".join(f"v{k + 1} = v{k} + v{k}\n" for k in range(200)) + "token = v200\n"
    assert _lexed(chain) == ["Zx9kk22Q"]


def test_setters_give_their_name_a_value():
    assert _lexed('conn.setPassword("Zx9!kk22Qp")') == ["Zx9!kk22Qp"]
    assert _lexed("x.password('Zx9!kk22Qp');") == ["Zx9!kk22Qp"]
    assert _lexed('getPassword("Zx9!kk22Qp")') == [] == _lexed('print("Zx9!kk22Qp")')
    assert _lexed('setPassword("Zx9!kk22Qp", "other")') == []
