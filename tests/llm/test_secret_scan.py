"""Secrets that share a word with other runs, and short ones behind a name."""

import base64
import random
import re
import string
from hashlib import sha256

from millrace.llm import secret_scan


def test_each_run_of_a_word_and_each_named_value_is_judged(spark):
    key, other = (sha256(x).hexdigest()[:40] for x in (b"k", b"o"))
    texts = [
        f'{{"id":"{other[:20]}","token":"{key}"}}', f"{key},{other},{key}", f"https://example.com/?order={other}&api_key={key}",
        "password = hunterxyz in", 'the "password":"kxqjwvzp", of', "dbPassword=Zk4!pq", "Authorization: Bearer qzkw", "a password of prose", None, "",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secret_scan.candidates(df).orderBy("doc_id", "place", "nth").collect()
    got = [(r.doc_id, r.place, r.nth, r.candidate) for r in found]
    assert got == [
        (0, 0, 0, other[:20]), (0, 0, 1, key), (1, 0, 0, key), (1, 0, 1, other), (1, 0, 2, key), (2, 0, 0, other), (2, 0, 1, key),
        (3, 2, 0, "hunterxyz"), (4, 1, 0, "kxqjwvzp"), (5, 0, 0, "Zk4!pq"), (6, 2, 0, "qzkw"),
    ]
    assert [r.prefix for r in found[:5]] == ['{"id":"', '","token":"', "", ",", ","]
    forest = secret_scan.train(secret_scan.labelled_findings(spark, 3000), trees=15)
    said = {(r.doc_id, r.place, r.nth): r.secret for r in secret_scan.scan(df, forest).collect()}
    assert len(said) == len(got) and not said[0, 0, 0] and said[0, 0, 1] and said[2, 0, 1] and said[3, 2, 0] and said[4, 1, 0]


def runs(text):
    """A character at a time: (place, run) of key characters, 16 at least with a digit among them, and up to two signs behind."""
    kinds = set(string.ascii_letters + string.digits + "_+/-")
    for place, w in enumerate(re.findall(r"[^\x20\x09-\x0D]+", text or "")):
        i = 0
        while i < len(w):
            j = i
            while j < len(w) and w[j] in kinds:
                j += 1
            if j - i >= 16 and any(c in string.digits for c in w[i:j]):
                end = j
                while end < min(len(w), j + 2) and w[end] == "=":
                    end += 1
                yield place, w[i:end]
            i = max(j, i + 1)


def test_all_runs_of_any_text_are_candidates(spark):
    """Against a plain scan; runs of letters before the digit may be of any length."""
    rng = random.Random(9)
    texts = ["".join(rng.choice('abZ09_+/-="\'.,{}:  \n') * rng.choice([1, 1, 3, 12]) for _ in range(rng.randrange(60))) for _ in range(150)]
    texts += ["a" * 5000 + "1" + "b" * 5000, "x" * 200_000, "-" * 15 + "1", "1" * 15, f"{'k1' * 9}=={'k2' * 9}=", "é" + "a1" * 8 + "é" + "b2" * 8]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secret_scan.candidates(df).select("doc_id", "place", "nth", "candidate").collect()
    whole = re.compile(r"(?=.*[0-9])[A-Za-z0-9_+/-]{16,}={0,2}")
    got = [(r.doc_id, r.place, r.candidate) for r in sorted(found, key=lambda r: r[:3]) if whole.fullmatch(r.candidate)]
    assert got == [(i, *x) for i, t in enumerate(texts) for x in runs(t)]


def test_findings_of_other_hands(spark):
    """Written by hand, in forms that the made-up training set hasn't; the README has the shares."""
    rng = random.Random(11)
    pick = lambda n, of=string.ascii_letters + string.digits: "".join(rng.choice(of) for _ in range(n))
    hexes = lambda n: pick(n, "0123456789abcdef")
    b64 = lambda n: base64.b64encode(rng.randbytes(n)).decode()
    secret = [
        f"export GITHUB_TOKEN=ghp_{pick(36)}", f'{{"user":"bob","api_key":"{pick(32)}"}}', f"curl https://host.net/v1?limit=10&access_token={hexes(40)}",
        f"aws_secret_access_key = {b64(30)}", f"Authorization: Bearer {pick(48)}", f"postgres_password: {pick(20)}", f'"client_secret" : "{pick(24)}",',
        f"SECRET_KEY='{pick(50)}'", f"private_key={b64(45)}", f"stripe.api_key = 'sk_test_{pick(24)}'", f"auth: {hexes(32)}", f"DB_PASSWORD={pick(14, string.ascii_lowercase)}",
        f"<token>{pick(40)}</token> token: {pick(40)}", f"--password={pick(12)}", f"npm_config_token={hexes(36)}", f"credentials: {b64(24)}",
        f"slack token xoxb-{pick(12, string.digits)}-{pick(24)}", f"secret: {hexes(64)}", f'apikey => "{pick(28)}"', f"passwd:{pick(10)}",
    ]
    other = [
        f"merge commit {hexes(40)} into main", f"md5sum {hexes(32)} image.iso", f"ticket ABC-{pick(14, string.digits)} closed", f"isbn 978{pick(13, string.digits)}",
        f"see https://example.org/articles/{pick(6, string.digits)}/the-long-title-of-a-page", "call get_all_items_from_basket_v2 first", f"uuid {hexes(8)}-{hexes(4)}-{hexes(4)}-{hexes(4)}-{hexes(12)}",
        "open /var/log/nginx/access_2024_01_02/error", "password: changeme", 'token = "your_token_here_123"', f"phone +{pick(15, string.digits)}", f"etag {hexes(40)} unchanged",
        f"sha256:{hexes(64)} of the layer", f"invoice 2024-{pick(16, string.digits)}", "password = required", f"docker pull image:{pick(4, string.digits)}-build-2024-01-01-stable",
        f"order_number={pick(18, string.digits)}", f"revision {hexes(40)}", "secret: null", "api_key=xxxxxxxxxxxxxxxxxxxx1",
    ]
    forest = secret_scan.train(secret_scan.labelled_findings(spark))
    df = spark.createDataFrame(list(enumerate(secret + other)), "doc_id long, text string")
    said = {r.doc_id for r in secret_scan.scan(df, forest).filter("secret").collect()}
    missed, wrong = [secret[i] for i in range(len(secret)) if i not in said], [(secret + other)[i] for i in sorted(said) if i >= len(secret)]
    print(len(missed), missed, len(wrong), wrong)
    assert len(missed) <= len(secret) * 0.2 and len(wrong) <= len(other) * 0.2


def test_passwords_in_urls_key_lines_and_runs_of_letters(spark):
    letters = "kQzWvRtYpLmNbXcZsDfGhJkLqWeRtYuI"
    key = ["-----BEGIN RSA PRIVATE KEY-----", "Proc-Type: 4,ENCRYPTED", "", "qwErTyuIop", "ab+/cd==", "-----END RSA PRIVATE KEY-----", "after it"]
    texts = [
        "postgres://bob:hunter2pass@db.host/x and http://host:80/a@b", "redis://:zk!q@h", f"https://u:a!{letters}@h", f"see {letters} here", "\n".join(key),
        "\r\n".join(key), "-----BEGIN PRIVATE KEY----- stands here without an end", "-----BEGIN CERTIFICATE-----\nqwErTyuIop\n-----END CERTIFICATE-----",
        "a" * 19, "-" * 30 + " " + "_/" * 20, "://" * 20_000 + ":" * 20_000 + "@", "-----BEGIN PRIVATE KEY-----\n" + "ab\n" * 3000 + "-----END PRIVATE KEY-----",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secret_scan.candidates(df).orderBy("doc_id", "place", "nth").collect()
    assert [(r.doc_id, r.place, r.candidate, r.key_line) for r in found if r.doc_id < 10] == [
        (0, 0, "hunter2pass", False), (1, 0, "zk!q", False), (2, 0, "a!", False), (2, 0, letters, False), (3, 1, letters, False),
        (4, 6, "qwErTyuIop", True), (4, 7, "ab+/cd==", True), (5, 6, "qwErTyuIop", True), (5, 7, "ab+/cd==", True),
    ]
    assert [r.place for r in found if r.doc_id == 11] == list(range(3, 3003)) and all(r.key_line for r in found if r.doc_id == 11)


def test_features_by_hand(spark):
    """Each feature of two candidates, counted by hand."""
    df = spark.createDataFrame([(0, "my secret is ftp://bob:Xy9zzzzbcdf@h/a. now"), (1, 'api_key="table/12-ABCD1234EF"')], "doc_id long, text string")
    got = {r.doc_id: r.asDict() for r in secret_scan.features(secret_scan.candidates(df)).collect()}
    one = {"length": 11, "digits": 1 / 11, "capitals": 1 / 11, "letters": 10 / 11, "distinct": 8 / 11, "transitions": 3 / 11, "slashes": 0, "url": 1, "named_near": 1, "quoted": 0, "one_char": 4 / 11, "separators": 0, "consonants": 8 / 11, "userinfo": 1, "block": 0}
    two = {"length": 19, "digits": 6 / 19, "capitals": 6 / 19, "letters": 11 / 19, "dictionary": 5 / 19, "hex": 0, "slashes": 1, "url": 0, "named": 1, "other_near": 0, "assigned": 1, "quoted": 1, "one_char": 0, "separators": 2 / 19, "consonants": 0, "userinfo": 0}
    for i, want in enumerate([one, two]):
        assert {k: round(got[i][k], 9) for k in want} == {k: round(v, 9) for k, v in want.items()}


def test_precision_and_recall_on_forms_of_other_hands(spark):
    """Ten findings each of forms that the training set hasn't; the README has the shares."""
    rng = random.Random(5)
    some = string.ascii_letters + string.digits
    pick = lambda n, of=some: "".join(rng.choice(of) for _ in range(n))
    hexes = lambda n: pick(n, "0123456789abcdef")
    b64 = lambda n: base64.b64encode(rng.randbytes(n)).decode()
    word = lambda: rng.choice("quarterly report mountain weather engine committee border history kitchen museum planet orchestra".split())
    secret = [
        lambda: f"GITHUB_TOKEN: ghp_{pick(36)} # {word()}", lambda: f"aws_access_key_id = AKIA{pick(16, string.ascii_uppercase + string.digits)}", lambda: f"mongodb+srv://{word()}:{pick(12)}@cluster0.{word()}.mongodb.net/{word()}",
        lambda: f"-----BEGIN PRIVATE KEY-----\n{b64(48)}\n{b64(48)}\n-----END PRIVATE KEY-----", lambda: f"client.secret={pick(32, string.ascii_letters)}", lambda: f"{word()} {{ password: '{pick(14)}' }}",
        lambda: f"curl -u {word()} -H \"X-Auth-Token: {hexes(32)}\" {word()}.org", lambda: f"jdbc_password={pick(10)} {word()}", lambda: f"set the api key: {b64(33)} before the {word()}", lambda: f"const apiKey = '{pick(39)}';",
    ]
    other = [
        lambda: f"the {word()} at github.com/{word()}/{word()}/blob/{hexes(40)}/{word()}.md", lambda: f"integrity sha512-{b64(64)} of {word()}", lambda: f"compareTheLongest{word().title()}Of{word().title()}First(x)", lambda: f"tracking number 1Z{pick(16, string.digits)} of the {word()}",
        lambda: f"/home/{word()}/{word()}-{word()}/{word()}_{word()}/{word()}.cfg", lambda: f"id: {hexes(8)}-{hexes(4)}-{hexes(4)}-{hexes(4)}-{hexes(12)} {word()}", lambda: f"password: <{word()}>", lambda: f"the {word()}-{word()}-and-{word()}-{word()} of {pick(4, string.digits)}",
        lambda: f"on {pick(18, string.digits)} the {word()} of the {word()}", lambda: f"https://{word()}.org/{word()}/2021/05/{word()}-{word()}-{word()}-{pick(5, string.digits)}.html",
    ]
    made = [(f(), True) for f in secret for _ in range(10)] + [(f(), False) for f in other for _ in range(10)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(made)], "doc_id long, text string")
    forest = secret_scan.train(secret_scan.labelled_findings(spark))
    said = {r.doc_id for r in secret_scan.scan(df, forest).filter("secret").collect()}
    right = sum(made[i][1] for i in said)
    missed, wrong = [t for i, (t, y) in enumerate(made) if y and i not in said], [made[i][0] for i in sorted(said) if not made[i][1]]
    print("recall", right / 100, "precision", right / len(said), missed, wrong)
    assert right / 100 >= 0.9 and right / len(said) >= 0.9
