"""Labelled findings for the secret scan, made by rule from a seed: lines with one value each, secret or not.

The forms are those of public credentials and of what is taken for them; values, names, words and contexts are drawn
anew for every line. Rules that label findings of a corpus (`secrets.known_label`) leave many of these open, so a forest that has
seen them decides by the value and its surroundings together.
"""

from __future__ import annotations

import random
import string
from collections.abc import Callable, Iterator

# Names, prefixes and words as they stand in public code and settings.
_NAMES = "password passwd pwd secret client_secret api_key apikey access_key auth_token token private_key db_password SECRET_KEY API_TOKEN credentials passphrase".split()
_HASHES = "commit sha sha256 md5 etag checksum digest revision hash blob tree integrity".split()
_PLAIN = "name title id build version path file module request order invoice session color label ref branch image size".split()
_WORDS = "river stone winter orange silent garden copper window market yellow bridge candle forest planet mirror pocket thunder velvet harbor castle".split()
_PREFIXES = "sk_live_ sk_test_ ghp_ gho_ glpat- xoxb- xoxp- AIza pk_live_ SG. hf_ npm_ dop_v1_ shpat_".split()
_PATHS = "src/app.py config/prod.env settings.yml deploy/values.yaml README.md docs/guide.md tests/test_auth.py lib/client.js notes.txt web".split()
_BASE62 = string.ascii_letters + string.digits


def _some(rng: random.Random, letters: str, n: int) -> str:
    return "".join(rng.choice(letters) for _ in range(n))


def _words(rng: random.Random, n: int) -> list[str]:
    return [rng.choice(_WORDS) for _ in range(n)]


def _token(rng):
    return rng.choice(_PREFIXES) + _some(rng, _BASE62, rng.randrange(16, 48))


def _spelled(rng):
    return _some(rng, _BASE62, rng.randrange(2, 8)) + rng.choice("!@#$%^*?") + _some(rng, _BASE62 + "!@#$%", rng.randrange(3, 14))


def _leet(rng):
    return "".join(_words(rng, rng.randrange(1, 3))).translate(str.maketrans("aeio", "4310")).capitalize() + str(rng.randrange(10, 9999)) + rng.choice(["", "!", "#"])


def _mixed(rng):
    return _some(rng, _BASE62 + "+/", rng.choice((20, 24, 32, 40, 43, 64))) + rng.choice(["", "=", "=="])


def _hex(rng):
    return _some(rng, "0123456789abcdef", rng.choice((16, 18, 24, 32, 40, 64)))


def _jwt(rng):
    return "eyJ" + ".".join(_some(rng, _BASE62 + "-_", rng.randrange(20, 60)) for _ in range(3))


def _phrase(rng):
    return "".join(_words(rng, 4))


def _uuid(rng):
    return "-".join(_some(rng, "0123456789abcdef", n) for n in (8, 4, 4, 4, 12))


def _number(rng):
    return str(rng.randrange(10**7, 10**16))


def _date(rng):
    return f"{rng.choice(['report', 'backup', 'log', 'release'])}_{rng.randrange(1990, 2030)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}"


def _version(rng):
    return f"{rng.choice(['v', 'python', 'lib', 'release-'])}{rng.randrange(20)}-{rng.randrange(30)}-{rng.randrange(90)}{rng.choice(['', '-rc1', '-beta2', '-alpha'])}"


def _identifier(rng):
    return rng.choice(["_".join, "-".join])(_words(rng, rng.randrange(2, 4))) + rng.choice(["", "_id", "_v2", "2", "-01"])


def _camel(rng):
    first, *rest = _words(rng, 3)
    return first + "".join(w.capitalize() for w in rest) + rng.choice(["", "V2", "32", "1"])


def _constant(rng):
    return "_".join(_words(rng, rng.randrange(2, 4))).upper()


def _code(rng):
    return f"{_some(rng, string.ascii_uppercase, rng.randrange(2, 4))}-{rng.randrange(1990, 2030)}-{rng.randrange(10**4, 10**7)}"


def _placeholder(rng):
    w = rng.choice(_NAMES).upper()
    return rng.choice([f"${{{w}}}", f"<{w.lower()}>", f"your-{w.lower()}-here", "changeme123", "xxxxxxxxxxxx1", f"os.environ[{w}]", f"{{{{ {w} }}}}", "example_password1", f"${w}", f"process.env.{w}", f"get{_camel(rng)}(1)"])


def _path(rng):
    return "/".join(_words(rng, 3)) + f"/{rng.choice(_WORDS)}{rng.randrange(1, 99)}"


def _shown(rng, value: str, names: list[str]) -> tuple[str, str]:
    name = rng.choice(names)
    quote = rng.choice(['"', "'"])
    return rng.choice(
        [
            (f"{name} = {quote}", f"{quote}"),
            (f'"{name}": "', '",'),
            (f"{name}: ", ""),
            (f"{name}=", ""),
            (f"export {name.upper()}=", ""),
            (f"--{name} ", " --verbose"),
            (f"{name} => {quote}", f"{quote},"),
        ]
    )


def _loose(rng, value: str) -> tuple[str, str]:
    w = _words(rng, 4)
    return rng.choice([(f"{w[0]} {w[1]} ", f" {w[2]} {w[3]}"), (f'{w[0]}("', f'") {w[1]}'), (f"{w[0]} {w[1]}: ", "."), (f"see {w[0]} (", f") {w[1]}")])


def _lines() -> list[tuple[str, int, Callable, Callable]]:
    """(kind, label, value, context) of all forms."""
    named = lambda rng, v: _shown(rng, v, _NAMES)
    hashed = lambda rng, v: rng.choice([(f"{rng.choice(_HASHES)} ", ""), (f"{rng.choice(_HASHES)}: ", ""), _shown(rng, v, _HASHES)])
    other = lambda rng, v: _shown(rng, v, _PLAIN)
    url = lambda rng, v: (f"postgres://{rng.choice(_WORDS)}:", f"@{rng.choice(_WORDS)}.example.com:5432/{rng.choice(_WORDS)}")
    bearer = lambda rng, v: (rng.choice(["Authorization: Bearer ", "curl -H 'Authorization: Bearer ", "bearer "]), "")
    secret = [("token", _token), ("spelled", _spelled), ("leet", _leet), ("mixed", _mixed), ("hex", _hex), ("jwt", _jwt)]
    out = [(f"named {k}", 1, v, named) for k, v in [*secret, ("phrase", _phrase)]]
    out += [("loose token", 1, _token, _loose), ("loose jwt", 1, _jwt, _loose), ("loose mixed", 1, _mixed, _loose), ("loose aws", 1, lambda rng: "AKIA" + _some(rng, string.ascii_uppercase + "234567", 16), _loose)]
    out += [("url spelled", 1, lambda rng: _some(rng, _BASE62 + "!$%", rng.randrange(6, 20)), url), ("url leet", 1, _leet, url), ("bearer mixed", 1, _mixed, bearer), ("bearer jwt", 1, _jwt, bearer), ("bearer token", 1, _token, bearer)]
    plain = [("uuid", _uuid), ("number", _number), ("date", _date), ("version", _version), ("identifier", _identifier), ("camel", _camel), ("constant", _constant), ("code", _code), ("path", _path)]
    out += [(f"other {k}", 0, v, other) for k, v in plain] + [(f"loose {k}", 0, v, _loose) for k, v in plain]
    out += [("hashed hex", 0, _hex, hashed), ("hashed mixed", 0, lambda rng: _some(rng, _BASE62 + "+/", 43) + "=", hashed), ("named placeholder", 0, _placeholder, named), ("loose hex color", 0, lambda rng: _some(rng, "0123456789abcdef", 8), lambda rng, v: ("color: #", ";"))]
    return out


def lines(seed: int, each: int, kinds: Callable[[str], bool] = lambda kind: True) -> Iterator[tuple[str, str, int, int, int, str]]:
    """(kind, text, start, stop, label, path): `each` lines of every kind."""
    rng = random.Random(seed)
    for kind, label, value_of, context in _lines():
        for _ in range(each):
            value = value_of(rng)
            before, after = context(rng, value)
            lead = " ".join(_words(rng, rng.randrange(4))) + rng.choice(["\n", "\n    ", "; ", ""])
            text = f"{lead}{before}{value}{after}\n{' '.join(_words(rng, 3))}"
            start = len(lead) + len(before)
            if kinds(kind):
                yield kind, text, start, start + len(value), label, rng.choice(_PATHS)
