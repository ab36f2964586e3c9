"""Labelled findings for the secret scan's forest: kinds of values in contexts on paths, true and false. DataFrame functions only.

Each row is a short text that holds one value, with the verdict a reviewer gives to it. Values, names, forms of
assignment, paths and the words around are picked by digests of the seed, the kind and the row's number, so the rows are
the same in every session. No text of the corpus is among them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SECRET_NAMES = (
    "token", "secret", "password", "passwd", "pwd", "api_key", "apiKey", "api-key", "access_key", "private_key", "client_secret",
    "credentials", "auth_token", "authorization", "secret_key", "token_value", "db_password", "API_KEY", "SECRET_KEY", "passphrase",
)
PLAIN_NAMES = (
    "id", "commit", "sha256", "md5", "etag", "checksum", "version", "file", "name", "session_name", "trace", "request_id",
    "build", "image", "path", "title", "key_figure", "order", "revision", "digest",
)
WORDS = (
    "the", "of", "and", "in", "a", "was", "for", "on", "are", "river", "les", "une", "der", "und", "des", "que", "para", "house",
    "see", "page", "with", "ago", "une", "von", "mit", "fell", "stood", "high", "note", "data",
)
# Forms of giving a value to a name.
GIVEN = ('{n} = "{v}"', "{n}: '{v}'", "{n}={v}", '"{n}": "{v}"', "export {n}={v}", "{n}: {v}", "{n} => '{v}'", '{n}="{v}"')
PATHS = ("", "src3", "src12", "config/app.yaml", "src/main/settings.py", "deploy/prod.env", "web", "a/b/c.txt")
TEST_PATHS = ("tests/unit/test_app.py", "docs/example.md", "examples/demo.env", "fixtures/mock.json")
PROSE = ("{w} {v} {w}", "{w} ({v}) {w}", "{w}: {v}. {w}", "https://{w}.org/{v}/{w}", "{w} commit {v} of {w}", "{w} by the author {v} {w}")


PLACEHOLDERS = (
    "your-{w}-here-12345", "example_{w}_1_example_{w}", "xxxxxxxxxxxx0000", "changeme-{w}-1", "<insert-{w}-0001>", "0000000000000000",
    "test-{w}-test-{w}-01", "dummy_{w}_value_1234567", "${{w}_VALUE_01}", "sample-{w}-sample-2",
)
BEARER, URL = ("Authorization: Bearer {v}",), tuple(f"{scheme}://{{v}}@db.host/x" for scheme in ("postgres", "https", "mysql", "redis"))
# Kind, label, shape of the value, forms around it and names in those forms.
KINDS = (
    *[(f"given_{k}", 1, k, GIVEN, SECRET_NAMES) for k in ("hex", "base", "phrase", "short", "letters")],
    *[(f"given_{k}", 0, k, GIVEN, SECRET_NAMES) for k in ("placeholder", "number", "words")],
    *[(f"bearer_{k}", 1, k, BEARER, SECRET_NAMES) for k in ("hex", "base")],
    *[(k, 1, k, (*PROSE[:3], *GIVEN[:3]), (*SECRET_NAMES, *PLAIN_NAMES)) for k in ("jwt", "akia", "ghp", "live")],
    ("pem", 1, "pem", PROSE[:1], SECRET_NAMES), ("url_user", 1, "user", URL, SECRET_NAMES), ("url_placeholder", 0, "nobody", URL, SECRET_NAMES),
    *[(f"named_{k}", 0, k, GIVEN, PLAIN_NAMES) for k in ("hex", "uuid", "number", "base", "words", "path")],
    *[(f"prose_{k}", 0, k, PROSE, PLAIN_NAMES) for k in ("hex", "uuid", "number", "base", "words", "path")],
)


def _pick(options: Column, *salt: Column | str) -> Column:
    return F.element_at(options, (F.pmod(F.xxhash64(*salt), F.size(options)) + 1).cast("int"))


def _strings(options: Sequence[str]) -> Column:
    return F.array(*[F.lit(o) for o in options])


def labelled_findings(spark: SparkSession, each: int = 120, seed: int = 1) -> DataFrame:
    """``(doc_id, kind, label double, value, text, path)``: ``each`` rows of every kind, label 1 for secrets.

    Secrets: values of letters and digits, hex, base 64 and pass phrases given to a credential's name, bearer values, web tokens,
    keys of known forms, private key blocks, user and password of URLs. Others: the same looks under plain names and in
    prose (hashes, UUIDs, numbers, paths), placeholders, numbers and words given to a credential's name.
    """
    kinds = F.array(*[
        F.struct(F.lit(k).alias("kind"), F.lit(float(label)).alias("label"), F.lit(shape).alias("shape"), _strings(forms).alias("forms"), _strings(names).alias("names"))
        for k, label, shape, forms, names in KINDS])
    out = spark.range(0, each, 1, 1).select("id", F.explode(kinds).alias("f")).select("id", "f.*")
    out = out.withColumn("salt", F.concat_ws(":", F.lit(str(seed)), "id", "kind"))
    number = lambda name, low, high: F.pmod(F.xxhash64("salt", F.lit(name)), F.lit(high - low + 1)).cast("int") + low
    words = _strings(WORDS)
    out = out.withColumns({
        "w": F.transform(F.sequence(F.lit(0), F.lit(17)), lambda k: _pick(words, F.col("salt"), k)),
        "hex": F.concat(F.md5("salt"), F.md5(F.concat("salt", F.lit("+")))),
        "base": F.regexp_replace(F.base64(F.unhex(F.sha2("salt", 512))), "[+/=\\s]", "k"),
        "n": number("n", 16, 40), "m": number("m", 6, 9), "few": number("few", 1, 4), "mark": _pick(_strings("&!#$_-.*"), "salt", F.lit("mark")),
    })
    out = out.withColumns({
        "digits": F.rpad(F.regexp_replace("hex", "[a-f]", ""), 40, "4711"), "letters": F.translate("hex", "0123456789", "ghijklmnop"),
        "upper": F.upper(F.regexp_replace("base", "[0189]", "Q")),
    })
    left = lambda c, n: F.left(F.col(c), F.lit(n) if isinstance(n, int) else n)
    piece = lambda c, at, n: F.substring(c, at, n)
    word = lambda k: F.get("w", F.lit(k))
    phrase = F.concat(F.initcap(word(1)), left("base", F.col("m")), "mark", left("digits", F.col("few")))
    shapes = {
        "hex": left("hex", F.get(F.array(F.lit(32), F.lit(40), F.lit(64)), number("size", 0, 2))), "base": left("base", F.col("n")), "phrase": phrase,
        "short": F.concat(left("letters", F.col("m")), left("digits", 2)), "letters": left("letters", F.greatest("n", F.lit(20))),
        "placeholder": F.replace(_pick(_strings(PLACEHOLDERS), "salt", F.lit("p")), F.lit("{w}"), word(3)), "number": left("digits", F.col("n") - 4),
        "words": F.concat_ws("-", word(0), word(1), word(2), F.lit("of-the"), left("digits", 2), F.lit("section")),
        "jwt": F.concat(F.lit("eyJ"), piece("base", 1, 20), F.lit(".eyJ"), piece("base", 21, 40), F.lit("."), piece("base", 40, 43)),
        "akia": F.concat(F.lit("AKIA"), left("upper", 16)), "ghp": F.concat(F.lit("ghp_"), left("base", 36)), "live": F.concat(F.lit("sk_live_"), left("base", 24)),
        "pem": F.concat(F.lit("-----BEGIN PRIVATE KEY-----\n"), piece("base", 1, 64), F.lit("\n"), piece("base", 9, 64), F.lit("\n-----END PRIVATE KEY-----")),
        "user": F.concat(_pick(_strings(("admin", "root", "app", "svc", "user")), "salt", F.lit("u")), F.lit(":"), phrase),
        "nobody": F.concat(F.lit("user:"), _pick(_strings(("password", "example", "test-password", "username")), "salt", F.lit("u"))),
        "uuid": F.concat_ws("-", *[piece("hex", a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]),
        "path": F.concat(F.lit("/"), F.concat_ws("/", word(0), word(1), F.concat(F.lit("page"), left("digits", 3)), word(2), word(4))),
    }
    value = F.coalesce(*[F.when(F.col("shape") == k, v) for k, v in shapes.items()])
    out = out.withColumns({"value": value, "form": _pick(F.col("forms"), "salt", F.lit("form")), "name": _pick(F.col("names"), "salt", F.lit("name"))})
    body = F.replace(F.replace(F.replace("form", F.lit("{w}"), word(5)), F.lit("{n}"), F.col("name")), F.lit("{v}"), F.col("value"))
    around = lambda at: F.array_join(F.slice("w", at, 5), " ")
    paths = F.when(F.col("label") > 0, _strings(PATHS)).otherwise(_strings((*PATHS, *TEST_PATHS)))
    return out.select(
        F.concat_ws(":", "id", "kind").alias("doc_id"), "kind", "label", "value",
        F.concat_ws(" ", around(8), body, around(13)).alias("text"), _pick(paths, "salt", F.lit("path")).alias("path"))
