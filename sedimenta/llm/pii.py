"""Personal data is replaced by surrogates of its own kind, with DataFrame and SQL functions only.

One pattern finds the entities of a text; the text is split around them and put together again with
each entity's surrogate. A surrogate is a keyed function of the entity, so an entity has the same
one in every text (coreference), and it keeps the entity's type, format, script and gender:

- phone, card, account and IPv4 numbers go through a keyed Feistel permutation of their digits (of
  the address's halves), within their own separators. A permutation gives different numbers different
  surrogates. The country code of a phone number is told from its digits and stays, as does a trunk zero;
  what follows is permuted, so all formats of a number keep one surrogate. A valid card number or IBAN
  stays valid and an invalid one invalid; letters of an IBAN's bank code are permuted too.
- names keep the forms of address and particles, take first names of the same gender and script, and a
  family name spelled from syllables of that script; initials go through a keyed cycle of the alphabet;
  case is kept, and parts of a name map alike in every mention. Parts of a text's names that occur again
  in that text, alone and capitalised, are replaced too.
- mail addresses get a new mailbox in their script under a reserved domain; hexadecimal secrets and
  access tokens get characters of the same classes at the same places, after the same prefix.

All surrogates are checked: all distinct entities are grouped by surrogate over the whole corpus, and all
but the first of a shared surrogate are keyed anew until none is shared, or equals an entity that really occurs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.store import Scratch, settle

# Forms of address by gender, first names by gender and script, syllables by script.
MALE_TITLES = ("Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Don", "Sr", "Г-н", "Господин", "Κύριος", "Κ", "Պարոն")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Doña", "Sra", "Г-жа", "Госпожа", "Κυρία", "Κα", "Տիկին")
NEUTRAL_TITLES = ("Dr", "Prof", "Professor")
FIRST_NAMES = {
    ("latin", "m"): "Adam Alan Bruno Carl Daniel David Emil Felix George Hugo Ivan Jacob James John Julian Leo Louis Lucas Mark Martin Max Michael Nils Oscar Pablo Paul Peter Robert Simon Thomas Victor William".split(),
    ("latin", "f"): "Ada Alice Amelia Anna Bella Carla Clara Diana Elena Ella Emma Eva Flora Grace Helen Ida Irene Jane Julia Laura Lena Linda Lucia Maria Mary Nina Nora Olivia Rosa Sarah Sofia Vera".split(),
    ("greek", "m"): "Αλέξανδρος Ανδρέας Γιώργος Δημήτρης Ιωάννης Κώστας Μιχάλης Νίκος Παύλος Πέτρος Σταύρος Χρήστος".split(),
    ("greek", "f"): "Αγγελική Άννα Βασιλική Δέσποινα Ειρήνη Ελένη Κατερίνα Μαρία Νίκη Σοφία Χριστίνα Ζωή".split(),
    ("armenian", "m"): "Արամ Արմեն Գագիկ Դավիթ Հակոբ Կարեն Սամվել Վահան".split(),
    ("armenian", "f"): "Անահիտ Աննա Գայանե Լուսինե Կարինե Մարիամ Նարե Սոնա".split(),
    ("cyrillic", "m"): "Алексей Андрей Борис Виктор Глеб Денис Егор Иван Игорь Кирилл Лев Максим Никита Олег Павел Роман".split(),
    ("cyrillic", "f"): "Алина Анна Вера Галина Дарья Елена Ирина Ксения Лидия Мария Нина Ольга Полина Раиса Софья Татьяна".split(),
}
SYLLABLES = {
    "latin": "ba be bi bo bu da de di do du fa fe fi fo ga ge go ha he ho ka ke ki ko la le li lo lu ma me mi mo mu na ne ni no ra re ri ro ru sa se si so ta te ti to tu va ve vi vo wa we wi ya yo za ze zi zo".split(),
    "greek": "βα βε βο γα γε γο δα δε δο θα θε κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο πα πε πο ρα ρε ρι ρο σα σε σο τα τε τι το φα φο χα χο".split(),
    "armenian": "բա բե բո գա գե գո դա դե զա կա կե կի կո լա լե լի լո մա մե մի մո նա նե նի նո պա պե սա սե սի սո տա տե վա վե".split(),
    "cyrillic": "ба бе бо ва ве ви во га го да де до за зи ка ке ко ла ле ли ло ма ме ми мо на не ни но па пе по ра ре ри ро са се си со та те ти то фа фе фо ха хо ча".split(),
}

#: Lower-case parts of a name, kept as they are.
PARTICLES = "von van der den de del della di da dos du la le ter ten zu zur bin ibn al el y".split()
#: Capitals that initials may be; each row is permuted in itself.
CAPITALS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝŁŠŽ", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЩЭЮЯ", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ", "ԱԲԳԴԵԶԷԸԹԺԻԼԽԾԿՀՁՂՃՄՅՆՇՈՉՊՋՌՍՎՏՐՑՓՔ")
#: Country calling codes: of one digit, of two, else of three.
CALLING_CODE = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
#: Prefixes of access tokens, which stay.
TOKEN = r"(?:AKIA|ASIA|AIza|gh[pousr]_|xox[abprs]-|glpat-|(?:sk|pk|rk)[-_](?:live_|test_|proj-)?|eyJ)"


def _any_of(words: Iterable[str]) -> str:
    """A pattern of these words, in listed case or capitals, that looks at one branch for each first letter."""
    tails: dict[str, set[str]] = {}
    for word in words:
        for form in (word, word.upper()):
            tails.setdefault(form[0], set()).add(form[1:])
    return "(?:" + "|".join(f"{c}(?:{'|'.join(sorted(more, key=lambda x: (-len(x), x)))})" for c, more in sorted(tails.items())) + ")"


_TITLE = rf"{_any_of(MALE_TITLES + FEMALE_TITLES + NEUTRAL_TITLES)}\.?"
_NAME = r"\p{Lu}[\p{L}\p{M}'’\-]*[\p{L}\p{M}]"
#: A part is a word, or initials with full stops; particles and single letters may precede it. What an entity is never hangs on what follows it.
_PART = rf"(?:(?:{'|'.join(PARTICLES)}|\p{{Lu}}) )*+(?!{_TITLE} )(?:{_NAME}|\p{{Lu}}\.(?:-?\p{{Lu}}\.)*+)"
_FIRST = _any_of(name for names in FIRST_NAMES.values() for name in names)
_PERSON = rf"(?<![\p{{L}}\p{{N}}])(?=\p{{Lu}})(?:(?:{_TITLE} ){{1,4}}(?:{_PART}|\p{{Lu}}(?![\p{{L}}\p{{N}}'’\-]))(?: {_PART})*+|{_FIRST}(?:-{_NAME})?(?: {_PART})++)"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: Kind -> pattern, in the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)*\.\p{L}{2,}",
    "ip": rf"(?<![\p{{L}}\p{{N}}.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\p{{L}}\p{{N}}]|\.\d)",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .\-]?(?:\(\d{1,5}\)[ .\-]?)?\d{2,5}(?:[ .\-]?\d{2,5}){1,4}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}[.\-]\d{3}[.\-]\d{4}|(?:\(0\d{2,4}\)|0\d{2,4})[ /\-]\d{3,4}[ \-]?\d{3,4})(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}\-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}\-])",
    "card": r"(?<![\p{L}\p{N}])(?:\d{13,19}|\d{4}([ \-])\d{4}\1\d{4}\1\d{4})(?![\p{L}\p{N}])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "token": rf"(?<![\p{{L}}\p{{N}}_\-]){TOKEN}[A-Za-z0-9_\-]{{16,}}(?:\.[A-Za-z0-9_\-]+){{0,2}}(?![\p{{L}}\p{{N}}])",
    "secret": r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![\p{L}\p{N}])",
    "name": _PERSON,
}
#: Without one of these characters or names, a text holds no entity; most texts need no more than this test.
_HINT = rf"[@0-9]|[A-Fa-f]{{32}}|{TOKEN}[A-Za-z0-9_\-]{{16}}|{_PERSON}"
_ANY = "|".join(PATTERNS.values())
#: Family names that collided so often are spelled twice as long, so a corpus with more names than short spellings still settles.
LONGER = 3


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _number(*parts: Column | str) -> Column:
    """60 bits of a keyed hash of the parts, as a long."""
    return F.conv(F.substring(F.sha2(F.concat_ws("\x1f", *[F.lit(p) if isinstance(p, str) else p for p in parts]), 256), 1, 15), 16, 10).cast("long")


def kind_of(entity: Column) -> Column:
    """The first kind whose pattern the whole entity is."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        out = F.when(entity.rlike(f"^(?:{pattern})$"), kind).otherwise(out)
    return out


def canonical(entity: Column, kind: Column) -> Column:
    """What mentions of one entity share: digits of numbers, lower case of the rest, names without title."""
    digits = F.regexp_replace(entity, r"[^0-9]", "")
    return (
        F.when(kind == "phone", F.substr(digits, F.length(_leading(entity)) + 1, F.length(digits)))
        .when(kind.isin("card", "ssn"), digits)
        .when(kind == "name", F.lower(F.regexp_replace(entity, f"^(?:{_TITLE} )+", "")))
        .when(kind == "iban", F.regexp_replace(entity, " ", ""))
        .when(kind == "ip", F.array_join(F.transform(F.split(entity, r"\."), lambda x: x.cast("int").cast("string")), "."))
        .when(kind == "token", entity)
        .otherwise(F.lower(entity))
    )


def _leading(phone: Column) -> Column:
    """The digits of a phone number that stay: country code and trunk zero."""
    digits = F.regexp_replace(phone, r"[^0-9]", "")
    code = F.when(phone.startswith("+"), F.regexp_extract(digits, CALLING_CODE, 1)).otherwise("")
    return F.concat(code, F.when(F.substr(digits, F.length(code) + 1, F.lit(1)) == "0", "0").otherwise(""))


def _power(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("long")


def permuted(digits: Column, key: Column | str) -> Column:
    """Digits to as many digits by a keyed, unbalanced Feistel network: a permutation for each length."""

    def network(digits: Column, n: Column, left: Column) -> Column:
        right = n - left
        start = F.struct(F.coalesce(F.nullif(F.substr(digits, F.lit(1), left), F.lit("")), F.lit("0")).cast("long").alias("l"), F.substr(digits, left + 1, right).cast("long").alias("r"))

        def turn(at: Column, i: Column) -> Column:
            new_l = F.pmod(at["l"] + _number(key, i.cast("string"), n.cast("string"), at["r"].cast("string")), _power(left))
            new_r = lambda l: F.pmod(at["r"] + _number(key, i.cast("string"), F.lit("r"), n.cast("string"), l.cast("string")), _power(right))  # noqa: E731, E741
            return _let(new_l, lambda l: F.struct(l.alias("l"), new_r(l).alias("r")))  # noqa: E741

        end = F.aggregate(F.array(*[F.lit(i) for i in range(3)]), start, turn)
        return _let(end, lambda e: F.concat(F.when(left > 0, F.lpad(e["l"].cast("string"), left, "0")).otherwise(""), F.lpad(e["r"].cast("string"), right, "0")))

    return _let(digits, lambda d: _let(F.length(d), lambda n: network(d, n, (n / 2).cast("int"))))


def _luhn(digits: Column) -> Column:
    """The check digit that makes digits followed by it valid."""
    n = F.length(digits)
    doubled = F.transform(F.sequence(F.lit(1), n), lambda i: F.substr(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 0, 2).otherwise(1))
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + x - F.when(x > 9, 9).otherwise(0))
    return (10 - total % 10) % 10


def _refill(form: Column, digits: Column) -> Column:
    """The form with its digits replaced, in order, by these."""
    pieces = F.split(F.regexp_replace(form, r"[0-9]", "\x00"), "\x00", -1)
    return _let(digits, lambda d: F.array_join(F.transform(pieces, lambda x, i: F.concat(x, F.substr(d, i + 1, F.lit(1)))), ""))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]", "")


def _card(entity: Column, key: Column) -> Column:
    def whole(digits: Column) -> Column:
        body, last = F.substr(digits, F.lit(1), F.length(digits) - 1), F.substr(digits, F.length(digits), F.lit(1)).cast("int")
        return _let(permuted(body, key), lambda new: F.concat(new, F.pmod(_luhn(new) + last - _luhn(body), F.lit(10)).cast("string")))

    return _refill(entity, _let(_digits(entity), whole))


def _phone(entity: Column, key: Column) -> Column:
    def whole(at: Column) -> Column:
        return _refill(entity, F.concat(at["lead"], permuted(F.substr(at["digits"], F.length(at["lead"]) + 1, F.length(at["digits"])), key)))

    return _let(F.struct(_leading(entity).alias("lead"), _digits(entity).alias("digits")), whole)


def _plain_digits(entity: Column, key: Column) -> Column:
    return _refill(entity, permuted(_digits(entity), key))


def _ip(entity: Column, key: Column) -> Column:
    def network(octet: Column) -> Column:
        start = F.struct((octet[0] * 256 + octet[1]).alias("l"), (octet[2] * 256 + octet[3]).alias("r"))

        def turn(at: Column, i: Column) -> Column:
            new_l = F.pmod(at["l"] + _number(key, "l", i.cast("string"), at["r"].cast("string")), F.lit(65536))
            return _let(new_l, lambda l: F.struct(l.alias("l"), F.pmod(at["r"] + _number(key, "r", i.cast("string"), l.cast("string")), F.lit(65536)).alias("r")))  # noqa: E741

        return F.aggregate(F.array(*[F.lit(i) for i in range(3)]), start, turn)

    octets = F.transform(F.split(entity, r"\."), lambda x: x.cast("long"))
    return _let(_let(octets, network), lambda e: F.concat_ws(".", *[F.floor(e[s] / d).cast("long") % 256 for s in "lr" for d in (256, 1)]))


def _pick(words: Column, number: Column) -> Column:
    return F.element_at(words, (F.pmod(number, F.size(words)) + 1).cast("int"))


def _among(word: Column, words: list[str]) -> Column:
    return F.array_contains(F.split(F.lit(" ".join(words)), " "), word)


def _other(words: Column, number: Column, than: Column) -> Column:
    """One of the words by number, but not the one that it stands for."""
    return _let(_pick(words, number), lambda w: F.when(F.lower(w) == F.lower(than), _pick(words, number + 1)).otherwise(w))


def _spelled(words: Column, number: Column, syllables: int) -> Column:
    """Syllables by the digits of the number."""
    start = F.struct(F.lit("").alias("text"), number.alias("rest"))
    step = lambda at, _: F.struct(F.concat(at["text"], _pick(words, at["rest"])).alias("text"), F.call_function("div", at["rest"], F.size(words)).alias("rest"))
    return F.aggregate(F.array(*map(F.lit, range(syllables))), start, step)["text"]


def _by_script(script: Column, lists: dict[str, list[str]]) -> Column:
    """The words of a script."""
    out = F.lit(" ".join(lists["latin"]))
    for name in (n for n in lists if n != "latin"):
        out = F.when(script == name, " ".join(lists[name])).otherwise(out)
    return F.split(out, " ")


def _initials(part: Column, key: str) -> Column:
    """Each capital becomes the next one of its row in the key's order, so none stays and different ones stay different."""
    rows = [sorted(row, key=lambda c: hashlib.sha256(f"{key}\x1finitial\x1f{c}".encode()).digest()) for row in CAPITALS]
    return F.translate(part, "".join(c for row in rows for c in row), "".join(c for row in rows for c in row[1:] + row[:1]))


def _name(entity: Column, key: str, attempt: Column) -> Column:
    title = F.regexp_extract(entity, f"^((?:{_TITLE} )*)", 1)
    bare = F.upper(F.regexp_replace(F.split(title, " ")[0], r"\.$", ""))
    script = F.lit("latin")
    for name in (n for n in SYLLABLES if n != "latin"):
        script = F.when(entity.rlike(rf"\p{{Is{name.title()}}}[.]? ?$|\p{{Is{name.title()}}}{{2}}"), name).otherwise(script)
    known = {g: [x.lower() for (_, of), names in FIRST_NAMES.items() if of == g for x in names] for g in "mf"}
    titles = {g: [x.upper() for x in names] for g, names in (("m", MALE_TITLES), ("f", FEMALE_TITLES))}

    def whole(parts: Column) -> Column:
        # a title says the gender, else the first name does; once for all parts
        first = F.lower(F.regexp_extract(parts[0], r"^[^\-]*", 0))
        female = _among(bare, titles["f"]) | (~_among(bare, titles["m"]) & _among(first, known["f"]))

        given = F.when(female, _by_script(script, {s: FIRST_NAMES[s, "f"] for s in SYLLABLES})).otherwise(_by_script(script, {s: FIRST_NAMES[s, "m"] for s in SYLLABLES}))
        return _let(F.struct(parts.alias("parts"), given.alias("given"), _by_script(script, SYLLABLES).alias("syllables")), renamed)

    def renamed(who: Column) -> Column:
        def one(part: Column, i: Column) -> Column:
            number = _number(key, "given", F.lower(part))

            spelled = [_spelled(who["syllables"], _number(key, kind, F.lower(part), attempt.cast("string")), 4) for kind in ("family", "longer")]
            family = F.initcap(F.when(attempt < LONGER, spelled[0]).otherwise(F.concat(*spelled)))
            is_given = (i < F.size(who["parts"]) - 1) & ((i == 0) | _among(F.lower(part), known["m"] + known["f"]))
            cased = lambda new: F.when((F.upper(part) == part) & (F.length(part) > 1), F.upper(new)).otherwise(new)
            return F.when(_among(part, PARTICLES), part).when(part.rlike(r"^\p{Lu}(?:$|\.)"), _initials(part, key)).when(is_given, cased(_other(who["given"], number, part))).otherwise(cased(family))

        return F.array_join(F.transform(who["parts"], one), " ")

    return F.concat(title, _let(F.split(F.substr(entity, F.length(title) + 1, F.length(entity)), " "), whole))


def _email(entity: Column, key: str, attempt: Column) -> Column:
    number = _number(key, "mail", F.lower(entity), attempt.cast("string"))
    script = F.lit("latin")
    for name in (n for n in SYLLABLES if n != "latin"):
        script = F.when(entity.rlike(rf"^\p{{Is{name.title()}}}"), name).otherwise(script)
    box = _spelled(_by_script(script, SYLLABLES), number, 5)
    tail = F.pmod(_number(key, "box", F.lower(entity), attempt.cast("string")), F.lit(10_000_000)).cast("string")
    return F.concat(box, F.lit("."), tail, F.lit("@mail.invalid"))


def _secret(entity: Column, key: str, attempt: Column) -> Column:
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.length(entity) - 1) / 64).cast("int")), lambda i: F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("secret"), F.lower(entity), attempt.cast("string"), i.cast("string")), 256))
    new = F.substr(F.array_join(blocks, ""), F.lit(1), F.length(entity))
    return F.when(F.upper(entity) == entity, F.upper(new)).otherwise(new)


def _token(entity: Column, key: Column) -> Column:
    """After the prefix, each character becomes one of its class; marks stay."""
    prefix = F.regexp_extract(entity, f"^({TOKEN})", 1)
    classes = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789")

    def one(i: Column) -> Column:
        c, number = F.substr(entity, i, F.lit(1)), _number(key, entity, i.cast("string"))
        out = c
        for row in classes:
            out = F.when(F.instr(F.lit(row), c) > 0, F.substr(F.lit(row), (F.pmod(number, F.lit(len(row))) + 1).cast("int"), F.lit(1))).otherwise(out)
        return out

    return F.concat(prefix, F.array_join(F.transform(F.sequence(F.length(prefix) + 1, F.length(entity)), one), ""))


def _mod_97(text: Column) -> Column:
    """The remainder of the number that digits and letters (A is 10) spell."""

    def turn(rest: Column, c: Column) -> Column:
        number = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
        return (rest * F.when(number > 9, 100).otherwise(10) + number) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), turn)


def _iban(entity: Column, key: Column, secret: str) -> Column:
    """Country and places of letters and digits stay; check digits are as right or wrong as they were."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    order = "".join(sorted(letters, key=lambda c: hashlib.sha256(f"{secret}\x1fiban\x1f{c}".encode()).digest()))
    compact = F.regexp_replace(entity, " ", "")

    def whole(at: Column) -> Column:
        body = F.substr(at, F.lit(5), F.length(at))
        new = F.translate(_refill(body, permuted(_digits(body), key)), order, order[1:] + order[0])
        checks = lambda own: 98 - _mod_97(F.concat(own, F.substring(at, 1, 2), F.lit("00")))
        return _let(new, lambda n: F.concat(F.lpad((F.pmod(checks(n) + F.substring(at, 3, 2).cast("int") - checks(body) - 2, F.lit(97)) + 2).cast("string"), 2, "0"), n))

    def spaced(new: Column) -> Column:
        pieces = F.split(F.regexp_replace(F.substr(entity, F.lit(3), F.length(entity)), r"[A-Z0-9]", "\x00"), "\x00", -1)
        return F.concat(F.substring(entity, 1, 2), F.array_join(F.transform(pieces, lambda x, i: F.concat(x, F.substr(new, i + 1, F.lit(1)))), ""))

    return _let(_let(compact, whole), spaced)


def surrogate(entity: Column, kind: Column, key: str, attempt: Column) -> Column:
    """The entity's replacement; attempt counts the keys that collided before."""
    again = lambda name: F.concat(F.lit(key + name), F.when(attempt > 0, attempt.cast("string")).otherwise(""))
    return (
        F.when(kind == "email", _email(entity, key, attempt))
        .when(kind == "ip", _ip(entity, again("ip")))
        .when(kind == "phone", _phone(entity, again("phone")))
        .when(kind == "ssn", _plain_digits(entity, again("ssn")))
        .when(kind == "card", _card(entity, again("card")))
        .when(kind == "iban", _iban(entity, again("iban"), key))
        .when(kind == "token", _token(entity, again("token")))
        .when(kind == "secret", _secret(entity, key, attempt))
        .when(kind == "name", _name(entity, key, attempt))
    )


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """(kind, id, entity): every distinct entity of the corpus, with a mention of it; id is its canonical form."""
    found = docs.where(F.col(text).rlike(_HINT)).select(F.explode(F.regexp_extract_all(text, F.lit(_ANY), F.lit(0))).alias("entity"))
    found = found.groupBy("entity").agg(F.first(kind_of(F.col("entity"))).alias("kind"))
    named = found.withColumn("id", canonical(F.col("entity"), F.col("kind")))
    return named.groupBy("kind", "id").agg(F.min("entity").alias("entity"))


#: Entities that were keyed anew: up to so many ride with each row, of which all are looked through for each entity; more are joined.
OVERRIDES = 2_000
#: Rounds of the collision check; each leaves a small part of the last one's collisions.
ROUNDS = 100


def collisions(scratch: Scratch, docs: DataFrame, text: str, key: str) -> DataFrame:
    """(kind, id, attempt): the entities whose first surrogate was another's, or a real entity, with the attempt that is theirs alone."""
    # what consists of initials only is permuted, and one letter may well occur
    checked = entities(docs, text).where((F.col("kind") != "name") | F.col("id").rlike(r"\p{L}[\p{L}\p{M}'’\-]"))
    every = scratch.save(checked.withColumn("attempt", F.lit(0)))
    for _ in range(ROUNDS):
        # written before it is compared, so that the comparison is planned on plain columns
        made = scratch.save(every.withColumn("new", canonical(surrogate(F.col("entity"), F.col("kind"), key, F.col("attempt")), F.col("kind"))))
        order = Window.partitionBy("kind", "new").orderBy("attempt", "id")
        real = made.select(F.col("kind").alias("k"), F.col("id").alias("real"))
        shared = made.withColumn("n", F.row_number().over(order)).join(real, (F.col("k") == F.col("kind")) & (F.col("real") == F.col("new")), "left")
        again = F.when((F.col("n") > 1) | F.col("real").isNotNull(), F.col("attempt") + 1).otherwise(F.col("attempt"))
        every = scratch.save(shared.select("kind", "id", "entity", again.alias("attempt"), (again > F.col("attempt")).alias("moved")))
        settle(docs.sparkSession)
        if not every.where("moved").limit(1).count():
            return every.where("attempt > 0").select("kind", "id", "attempt")
        every = every.drop("moved")
    raise ValueError(f"after {ROUNDS} rounds surrogates still collide: there are too few for these entities")


def _name_parts(names: Column) -> Column:
    """(old in lower case, new) of the parts of names; particles, initials and forms of address are none."""

    def of(name: Column) -> Column:
        title = F.length(F.regexp_extract(name["old"], f"^((?:{_TITLE} )*)", 1))
        old, new = (F.split(F.substr(name[x], title + 1, F.length(name[x])), " ") for x in ("old", "new"))
        pairs = F.zip_with(old, new, lambda o, n: F.struct(o.alias("old"), n.alias("new")))
        whole = F.filter(pairs, lambda p: (F.length(p["old"]) > 2) & ~_among(p["old"], PARTICLES) & ~p["old"].rlike(r"\."))
        return F.transform(whole, lambda p: F.struct(F.lower(p["old"]).alias("old"), p["new"].alias("new")))

    return F.array_distinct(F.flatten(F.transform(names, of)))


_IN_WORD = r"\p{L}\p{M}\p{N}'’\-"
_EDGE = rf"(?<![{_IN_WORD}])(?=[{_IN_WORD}])|(?<=[{_IN_WORD}])(?![{_IN_WORD}])"


def _bare_mentions(piece: Column, known: Column) -> Column:
    """The piece of text with capitalised words that are parts of known names replaced."""

    def one(word: Column) -> Column:
        new = F.get(F.filter(known, lambda k: k["old"] == F.lower(word)), F.lit(0))["new"]
        cased = F.when(F.upper(word) == word, F.upper(new)).otherwise(F.initcap(new))
        return F.when(word.rlike(r"^\p{Lu}"), F.coalesce(cased, word)).otherwise(word)

    return F.array_join(F.transform(F.split(piece, _EDGE, -1), one), "")


def replace_entities(docs: DataFrame, key: str, text: str = "text", check: bool = True, count_to: str | None = None) -> DataFrame:
    """docs, all columns, with every entity of the text replaced; count_to names a new column for the number of entities.

    Null texts stay null, empty ones empty; texts without entities stay as they are, byte by byte.
    Repeated rows are changed alike. Texts of any length are rewritten whole. The column of the text
    keeps its place; other columns may have any name. Equal entities have equal surrogates in all
    rows, different ones of a kind different surrogates, none of which occurs in docs (check=False leaves
    out the check, and with it one pass; then names, mailboxes and secrets may share a surrogate). A
    number is one entity in all its formats. An empty table stays empty.
    """
    spark = docs.sparkSession
    renamed = {}
    moved = collisions(Scratch(spark, "pii"), docs, text, key) if check else None
    n_moved = moved.count() if moved is not None else 0
    attempts = F.create_map().cast("map<string,int>")
    named = docs
    if n_moved and n_moved <= OVERRIDES:
        pairs = moved.select(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\x1f", "kind", "id"), "attempt"))).alias("__attempts"))
        named, attempts = docs.crossJoin(F.broadcast(pairs)), F.col("__attempts")  # one row
    elif n_moved:
        named, attempts = _with_attempts(docs, moved, text), F.col("__attempts")
    hint = F.col(text).rlike(_HINT)
    found = F.when(hint, F.regexp_extract_all(text, F.lit(_ANY), F.lit(0)))

    def one(entity: Column) -> Column:
        def of(kind: Column) -> Column:
            attempt = F.coalesce(F.element_at(attempts, F.concat_ws("\x1f", kind, canonical(entity, kind))), F.lit(0)) if n_moved else F.lit(0)
            return F.struct(entity.alias("old"), F.coalesce(surrogate(entity, kind, key, attempt), entity).alias("new"), (kind == "name").alias("is_name"))

        return _let(kind_of(entity), of)

    some = F.coalesce(F.size("__found"), F.lit(0)) > 0
    # an entity's surrogate is computed once for each text
    named = named.select("*", found.alias("__found")).select("*", F.when(some, F.transform(F.array_distinct("__found"), one)).alias("__new"))
    of_entity = lambda e: F.get(F.filter("__new", lambda n: n["old"] == e), F.lit(0))["new"]
    parts = _name_parts(F.filter("__new", lambda n: n["is_name"]))
    pieces = F.split(text, _ANY, -1)
    pieces = F.when(F.exists("__new", lambda n: n["is_name"]), _let(parts, lambda known: F.transform(pieces, lambda p: _bare_mentions(p, known)))).otherwise(pieces)
    news = F.array_append(F.transform("__found", of_entity), F.lit(""))
    rebuilt = F.array_join(F.flatten(F.zip_with(pieces, news, lambda p, s: F.array(p, F.coalesce(s, F.lit(""))))), "")
    renamed[text] = F.when(some, rebuilt).otherwise(F.col(text)).alias(text)
    out = [renamed.get(c, F.col(f"`{c}`")) for c in docs.columns]
    if count_to:
        out.append(F.when(some, F.size("__found")).otherwise(0).cast("long").alias(count_to))
    return named.select(*out)


def _with_attempts(docs: DataFrame, moved: DataFrame, text: str) -> DataFrame:
    """docs with a map of the attempts of the text's own entities, for more overrides than fit a broadcast; joined by text, not gathered."""
    texts = docs.where(F.col(text).rlike(_HINT)).select(F.col(text).alias("__text"), F.xxhash64(text).alias("__h")).distinct()
    each = texts.select("__text", F.explode(F.regexp_extract_all("__text", F.lit(_ANY), F.lit(0))).alias("entity")).withColumn("kind", kind_of(F.col("entity"))).withColumn("id", canonical(F.col("entity"), F.col("kind")))
    own = each.select("__text", "kind", "id").distinct().join(moved, ["kind", "id"])
    maps = own.groupBy("__text").agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("\x1f", "kind", "id"), "attempt"))).alias("__attempts"))
    return docs.join(maps, docs[text] == maps["__text"], "left").drop("__text").withColumn("__attempts", F.coalesce("__attempts", F.create_map().cast("map<string,int>")))
