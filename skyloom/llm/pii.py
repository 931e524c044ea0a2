"""Personal information in free text: spans of e-mail addresses, telephone numbers, identity numbers, street addresses and names.

Regular expressions propose spans, checksum validators and the words nearby set their score, and what reaches ``THRESHOLD`` is
found. Given names are in no list: they are learned from the corpus (``given_names``). Text is scanned as printed or as scanned: words broken at line ends are read across the break, and letters are compared by shape
(``shape``), so that a misread letter does not hide an item. Positions always refer to the text as it is.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.6
KINDS = ("email", "phone", "id_number", "address", "person_name")

# ---- fixed values: word lists ------------------------------------------------------------------------------------------------
TITLES = "Mr Mrs Miss Ms Dr Rev Capt Prof Sir Col Major Alderman Councillor Cllr Herr Frau Fräulein Frl Pfarrer Mme Mlle Monsieur Madame Mademoiselle Abbé Maître Sr Sra Srta Don Doña Dña Señor Señora Señorita Dra"
#: Capitalised words that begin sentences and notices, by language; they are no surnames.
NOT_SURNAMES_EN = "The This That These Those It In On At And But For From With Work Notice Members Residents Entries Enquiries Minute Old Eggs Fat A An No His Her Your Of Signed Apply Tickets Winners Anyone Mail Lost Found Wanted Sale Situation Telephone Phone Page Best Early Terms Free Good Try Box Lot Ref Case Write Cook Reward Road Street Lane Avenue Close Terrace Rd Ave St Terr Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February March April May June July August September October November December Steamer Star Sur Lady Residents Young Farmers Registered Journal Issn Office Value Delivery"
NOT_SURNAMES_DE = "Der Die Das Den Dem Des Ein Eine Im Am An Auf Bei Beim Bis Es Er Sie Und Oder Von Vom Wie Seit Man Mit Nach Zum Zur Aus Telefon Auskunft Anmeldungen Verloren Ausweis Nr Chiffre Gesucht Verkaufen Montag Dienstag Mittwoch Donnerstag Freitag Samstag Sonntag Januar Februar März Mai Juni Juli Oktober Dezember Mark"
NOT_SURNAMES_FR = "Le La Les Un Une Des Du De Et Ou Au Aux En On Il Elle Par Pour Perdu Depuis Hier Prix Tél Téléphone Leçons Écrire Vendre Demande Annonce Président Vapeur Route Travaux Lundi Mardi Mercredi Jeudi Vendredi Samedi Dimanche"
NOT_SURNAMES_ES = "El Los Las Una Del Al Se Su Por Para Desde Informes Falleció Extraviada Escribir Teléfono Tel Apartado Precios Busca Vende Clases Presidente Vapor Camino Obras Lunes Martes Miércoles Viernes Sábado Domingo Acudieron"
#: Those of them that are surnames too, where a form of address, a given name or initials stand before them on the line.
COMMON_SURNAMES = "Young Cook Page Lane Best Close March May August Case Good Mark Free Early Reward Street Old Box Lot Work Friday Mai Freitag Sonntag Montag Domingo Camino"
FIRM_BEFORE = "Messrs Gebr Gebrüder Casa Hijos Kaufhaus Maison Établ Établissements Étab Firma Hermanos Viuda Lady Star Steamer Dampfer Vapeur Vapor St Saint San Santa Sankt"
FIRM_AFTER = "& Bros Brothers Sons Son Co Ltd Stores Cie Fils Söhne Hnos Hermanos Hijos GmbH AG Cafe Café Hotel Company"
STREET_EN = "Street St Road Rd Avenue Ave Av Lane Ln Close Cl Terrace Terr Ter Drive Dr Court Ct Place Pl Square Sq Crescent Cres Gardens Gdns Grove Gr Row Mews Way Walk Boulevard Blvd Parade"
STREET_DE = "straße strasse str weg gasse platz allee"
STREET_FR = "rue avenue av boulevard bd place pl allée allées chemin ch impasse quai cours square passage faubourg r"
STREET_ES = "calle c/ avenida avda av plaza pza plza paseo pº ronda travesía cuesta callejón carretera ctra camino glorieta"
#: Words before a candidate that speak for a kind of item.
NAME_CUES = "Signed bride groom Winners erteilt starb Vorsitzende Vorsitzender presidente président Informes avisar Falleció décès adresser rapporter remember"
#: Second words of places: what they end is a place, not a person.
PLACE_WORDS = "Green Cross Quay Bridge Harbour Bay Moor Town City Hall Church Island River Valley"
#: Words of notices of lost papers, before or after a number.
FOUND_CUES = "abzugeben avisar rapporter restituer handed returned"
#: Words before a number that speak against a person's number.
NOT_A_PERSON = "registration registered docket invoice lot box ref reference case minute patent ISSN ISBN Chiffre Apartado"
ID_CUES = "number numbered card papers claim identity insurance social security passport licence clerk wallet Ausweis Ausweises Personalausweis Kennkarte Nr carte identité n° sécurité documento DNI NIF cédula identidad"
NUMBER_NOT_PHONE = "ISSN ISBN patent Minute shelf Lot Ref Box No Case Chiffre Apartado report register registered docket invoice"
COUNTRY_DIGITS = {"44": 10, "1": 10, "33": 9, "49": 11, "34": 9, "353": 9, "39": 10, "31": 9, "32": 9, "41": 9, "43": 11, "351": 9}
DNI_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"
# ------------------------------------------------------------------------------------------------------------------------------

_SHAPES = str.maketrans(
    dict(zip("0oöóòôø", "ooooooo")) | dict(zip("1li|ïíìî!", "lllllllll")) | dict(zip("5sſ$", "ssss")) | dict(zip("ceéèêë6ç", "cccccccc")) | dict(zip("nuaáàâäãñüúùû4", "nnnnnnnnnnnnnn")) | dict(zip("hb8", "hhh")) | dict(zip("tf7", "ttt")) | dict(zip("gq9", "ggg")) | dict(zip("vy", "vv")) | {"ß": "h"}
)


def shape(word: str) -> str:
    """The word by the shapes of its letters: letters that scans take for one another are the same."""
    return word.lower().translate(_SHAPES).replace("rn", "m").replace("cl", "d")


def _shapes(words: str) -> frozenset[str]:
    return frozenset(shape(w) for w in words.split())


NOT_SURNAMES = " ".join((NOT_SURNAMES_EN, NOT_SURNAMES_DE, NOT_SURNAMES_FR, NOT_SURNAMES_ES))
_STOP, _COMMON, _PLACE = frozenset(NOT_SURNAMES.lower().split()), frozenset(COMMON_SURNAMES.lower().split()), frozenset(PLACE_WORDS.lower().split())
_TITLES, _NOT, _FIRM_BEFORE, _FIRM_AFTER = _shapes(TITLES), _shapes(NOT_SURNAMES), _shapes(FIRM_BEFORE), _shapes(FIRM_AFTER)
_CUES, _ID_CUES, _NO_PHONE = _shapes(NAME_CUES), _shapes(ID_CUES), _shapes(NUMBER_NOT_PHONE)
_FOUND_CUES, _NO_PERSON = _shapes(FOUND_CUES), _shapes(NOT_A_PERSON)
_STREET_EN, _STREET_SHORT = _shapes(" ".join(w for w in STREET_EN.split() if len(w) > 3)), frozenset(w for w in STREET_EN.split() if len(w) <= 3)
_STREET_DE = tuple(shape(w) for w in STREET_DE.split())
_ABBREVIATED = _shapes("Terr Cres Gdns Blvd")

# ---- the text without line breaks --------------------------------------------------------------------------------------------
_MARKS = re.compile("[^\\W\\d_][\u0300-\u036f]+")


class Flat:
    """The text with broken words joined, line breaks as blanks and accents composed, and the way back to its positions.

    A hyphen at a line end goes where the word goes on in the same case; before a capital or a digit it stays.
    """

    def __init__(self, text: str):
        self.at, self.shift = [0], [0]
        parts: list[str] = []
        n = gone = 0
        lines = text.split("\n")
        last = len(lines) - 1
        for i, line in enumerate(lines):
            if i == last:
                parts.append(line)
                break
            keep = line
            if keep and keep[-1] in "\r \t":
                keep = keep.removesuffix("\r")
                keep = keep[:-1] if keep[-1:] in (" ", "\t") else keep
            cut = len(line) + 1 - len(keep)
            put = " "
            if len(keep) > 1 and keep[-1] in "-=¬/" and keep[-2].isalnum():
                c, nxt = keep[-1], lines[i + 1][:2]
                if c != "/" and (nxt[:1].islower() and keep[-2].islower() or nxt.isupper() and len(nxt) > 1 and keep[-2].isupper()):
                    keep, put, cut = keep[:-1], "", cut + 1
                elif c in "-/" and nxt[:1].isalnum() and (not nxt[:1].islower() or keep[-2].isdigit()):
                    put = ""
            parts.append(keep)
            n += len(keep) + len(put)
            if put:
                parts.append(put)
            if cut != len(put):
                gone += cut - len(put)
                self.at.append(n)
                self.shift.append(gone)
        self.s = "".join(parts)
        if not text.isascii() and (found := list(_MARKS.finditer(self.s))):
            self._compose(found)

    def _compose(self, found: list[re.Match]) -> None:
        s, old_at, old_shift = self.s, self.at, self.shift
        parts, cuts, last, n = [], [], 0, 0
        for m in found:
            c = unicodedata.normalize("NFC", m.group())
            parts += [s[last : m.start()], c]
            n += m.start() - last + len(c)
            last = m.end()
            if len(c) < len(m.group()):
                cuts.append((n, m.end()))
        self.s = "".join([*parts, s[last:]])
        steps = {0: 0}
        for new, was in cuts:
            steps[new] = was + old_shift[bisect_right(old_at, was) - 1] - new
        ends = [w for _, w in cuts]
        for was, sh in zip(old_at, old_shift):
            k = bisect_right(ends, was)
            new = was - (cuts[k - 1][1] - cuts[k - 1][0] if k else 0)
            steps[new] = was + sh - new
        self.at, self.shift = sorted(steps), [steps[k] for k in sorted(steps)]

    def back(self, start: int, end: int) -> tuple[int, int]:
        a = start + self.shift[bisect_right(self.at, start) - 1]
        b = end - 1 + self.shift[bisect_right(self.at, end - 1) - 1] + 1
        return a, b


# ---- validators --------------------------------------------------------------------------------------------------------------
_DIGITS = str.maketrans("OoQlIiſSsBbZz|", "00011155586221")


def digits(s: str) -> str:
    """The digits of a number, misread ones as what they stand for."""
    return re.sub(r"\D", "", s.translate(_DIGITS))


def luhn(d: str) -> bool:
    """Check digit of cards and of several national numbers."""
    return len(d) > 1 and sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def mod97(d: str) -> bool:
    """Key of a French social security number: 97 less the remainder of the number."""
    return len(d) == 15 and int(d[-2:]) == 97 - int(d[:13]) % 97


def iban(s: str) -> bool:
    """Check digits of a bank account number: with its first four characters at the end and letters as 10 to 35, it leaves 1 by 97."""
    x = re.sub(r"\W", "", s).upper()
    return len(x) > 4 and int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def dni(d: str, letter: str) -> bool:
    """Check letter of a Spanish identity number."""
    return len(d) == 8 and DNI_LETTERS[int(d) % 23] == letter.upper()


# ---- items with digits -------------------------------------------------------------------------------------------------------
_D = "[0-9OolISBbſ]"
_PHONE = re.compile(
    rf"(?<![\w.,/-])(?:\+[1-9lI]{_D}{{0,2}}[ .]?(?:\(0?\d{{1,4}}\)[ .]?)?(?:{_D}++[ ./-]?){{1,6}}(?<![ ./-])"  # country code
    rf"|\(0?{_D}{{2,5}}\)[ .-]?{_D}{{3,6}}(?:[ .-]?{_D}{{2,4}}){{0,3}}"  # area code in brackets
    rf"|[0Oo]{_D}(?:[ .]{_D}{{2}}){{4}}"  # pairs
    rf"|[0Oo]{_D}{{2,4}}[ /.-]{_D}{{3,5}}[ .-]?{_D}{{3,4}}"  # leading zero
    rf"|{_D}{{3}}[.-]{_D}{{3}}[.-]{_D}{{4}}"
    rf"|[6-9]{_D}{{2}} {_D}{{3}} {_D}{{3}}|[6-9]{_D} {_D}{{3}} {_D}{{4}}"
    rf"|{_D}{{3}}-{_D}{{4}})(?![\w-])"
)
_ID = re.compile(
    rf"(?<![\w.,/+-])(?:{_D}{{3}}(?P<sep>[ -]?){_D}{{2}}(?P=sep){_D}{{4}}"
    rf"|[A-Z]{{2}} ?{_D}{{2}} ?{_D}{{2}} ?{_D}{{2}} ?[A-D]"
    rf"|[A-Z] ?{_D}{{2}} ?{_D}{{3}} ?{_D}{{3}}"
    rf"|[12lI] ?{_D}{{2}} ?{_D}{{2}} ?{_D}{{2}} ?{_D}{{3}} ?{_D}{{3}}(?: ?{_D}{{2}})?"
    rf"|{_D}{{8}}[ -]?[A-Z]|[XYZ][ -]?{_D}{{7}}[ -]?[A-Z])(?![\w-])"
)
#: Cards and bank accounts, which only their check digits confirm.
_CARD = re.compile(r"(?<![\w.,/+-])(?:\d{4}(?P<gap>[ -]?)\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}|3\d{3}[ -]?\d{6}[ -]?\d{5})(?![\w-])")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z\d]{4}){2,7}(?: ?[A-Z\d]{1,3})?(?!\w)")
_SEEN = re.compile(r"[^\W\d_]+°?|n[°º]")


def _before(s: str, start: int, n: int = 48) -> list[str]:
    return [shape(w) for w in _SEEN.findall(s[max(0, start - n) : start])]


_AREA = re.compile(rf"\+?(?:{_D}|[\d ./()-]){{6,}}")
_NUMBER_LIKE = re.compile(rf"{_D}|\d")


def _areas(s: str) -> Iterator[tuple[int, int]]:
    """Where the text has enough characters of numbers in a row, misread digits among them, for an item of either kind.

    Every item that scores has six or more of them in one such row; two letters may stand before it, and a letter and what ends the item after.
    """
    for m in _AREA.finditer(s):
        if len(_NUMBER_LIKE.findall(m.group())) >= 6:
            yield max(0, m.start() - 4), min(len(s), m.end() + 3)


def _checked(x: str, d: str) -> bool | None:
    """Whether the check digits of a number of the shapes of ``_ID`` hold; None for shapes without any."""
    if re.fullmatch(r"\S{9}", x) and len(d) == 9:
        return luhn(d)
    if len(d) in (13, 15) and d[0] in "12":
        return mod97(d) if len(d) == 15 else None
    if x[-1].isalpha() and (len(d) == 8 or x[0] in "XYZ" and len(d) == 7):
        return dni(d if len(d) == 8 else str("XYZ".index(x[0])) + d, x[-1])
    return None


def find_numbers(s: str) -> Iterator[tuple[str, int, int]]:
    """Numbers of persons and telephones. A shape alone is worth half; a check digit that holds confirms it, one that fails rejects it
    unless a word nearby speaks for a person's number; shapes without one need their signs or such a word."""
    taken = []
    areas = list(_areas(s))
    for m in (m for a, b in areas for m in _ID.finditer(s, a, b)):
        x = m.group()
        d = digits(x)
        real = sum(c.isdigit() for c in x)
        after = {shape(w) for w in _SEEN.findall(s[m.end() : m.end() + 24])}
        near = _before(s, m.start())
        cue = any(w in _ID_CUES for w in near[-5:]) or not after.isdisjoint(_ID_CUES) or not after.isdisjoint(_FOUND_CUES)
        score = 0.5 if real >= 0.6 * len(d) else 0.0
        ok = _checked(x, d)
        if ok is not None:
            score += 0.5 if ok else -0.25
        elif m["sep"] or x.count(" ") >= 3:
            score += 0.25
        if near and near[-1] in _NO_PERSON:
            score -= 0.4
        score += 0.4 if cue else -0.1
        if score >= THRESHOLD:
            taken.append(m.span())
            yield "id_number", m.start(), m.end()
    for m in _IBAN.finditer(s) if areas else ():
        if iban(m.group()) and not any(m.start() < q and p < m.end() for p, q in taken):
            taken.append(m.span())
            yield "id_number", m.start(), m.end()
    for m in (m for a, b in areas for m in _CARD.finditer(s, a, b)):
        if luhn(digits(m.group())) and not any(m.start() < q and p < m.end() for p, q in taken):
            taken.append(m.span())
            yield "id_number", m.start(), m.end()
    for m in (m for a, b in areas for m in _PHONE.finditer(s, a, b)):
        a, b = m.span()
        x = m.group()
        if any(a < q and p < b for p, q in taken):
            continue
        d = digits(x)
        real = sum(c.isdigit() for c in x)
        score = 0.7 if real >= 0.6 * len(d) else 0.0
        if x[0] == "+":
            code = next((c for c in (d[:3], d[:2], d[:1]) if c in COUNTRY_DIGITS), None)
            most = len(code) + COUNTRY_DIGITS[code] if code else 13
            while len(digits(x)) > most and (cut := max(x.rfind(c) for c in " ./-")) > 0:
                x = x[:cut]
            b = a + len(x)
            score += 0.2 if len(digits(x)) >= 8 else -0.4
        elif len(d) == 7:
            near = _before(s, a, 24)[-1:]
            score -= 0.4 if any(w in _NO_PHONE for w in near) else 0.0
        elif not 9 <= len(d) <= 12:
            score -= 0.4
        if score >= THRESHOLD:
            yield "phone", a, b


# ---- e-mail addresses --------------------------------------------------------------------------------------------------------
_AT = re.compile(r"[@©(\[{<](?:(?<=[@©])| ?(?:at|AT|@|a) ?[)\]}>])")
_AT_WORD = re.compile(r" (?:at|AT) (?=[\w-]+ (?:dot|DOT) )")
_LOCAL = re.compile(r"[\w][\w.,+'-]*$")
_DOMAIN = re.compile(r"[\w-]+(?:(?:\.|,| ?[(\[]?\b(?:dot|DOT)\b[)\]]? ?)[\w-]*[^\W\d_][\w-]*)+")


def find_emails(s: str) -> Iterator[tuple[str, int, int]]:
    signs = list(_AT.finditer(s))
    if " dot " in s or " DOT " in s:
        signs += _AT_WORD.finditer(s)
    for m in signs:
        a, b = m.span()
        a -= s[a - 1 : a] == " "
        b += s[b : b + 1] == " "
        local = _LOCAL.search(s, max(0, a - 64), a)
        domain = _DOMAIN.match(s, b)
        if local and domain:
            yield "email", local.start(), domain.end()


# ---- street addresses --------------------------------------------------------------------------------------------------------
_UNIT = re.compile(r"(?:(?:Apt|Flat|Unit|Suite|Room|Fl|Apartment|[A-ZÀ-Þ]\w{2,4})\.? ?\w{1,3}, )$")
_UNIT_WORDS = _shapes("Apt Flat Unit Suite Room Apartment Floor")
_HOUSE = re.compile(rf"(?<![\w.,£$/+-])[1-9l]{_D}{{0,4}}(?![\d.,]*\d)")
_LETTER = re.compile(r" ?[A-Za-z]\b")
_CAP = re.compile(r"(?:(?:[A-ZÀ-Þ]|[805](?=[a-z]))[\wſ'’]*\.?|[A-ZÀ-Þ][\w'’]*-[\w'’]+)(?: |$|(?=\W))")
_FR = re.compile(
    r"(?: ?(?:bis|ter|quater|[A-Da-d]))?,? (?i:r[un][ec]|[aoun]v[ecoaun]+n?[unao]*[ec]|av\.|b[oau0]+[ul1]+[ec]v[aun][rn]d|bd\.?|p[l1i][aunf][ec][ec]|pl\.|[aun]l?[l1i]+[ée6c]+s?|[ec]h[ec]m[il1]n|imp[aun]ss[ec]|q[un]ai|[ec]ours|squar[ec]|passag[ec]|faubourg) "
    r"(?:(?:d|cl)[ecoun][sſ5l]?(?: [l1i][aun])? |(?:d|cl)[ec] l['’]|d['’]|[l1i][aunec][sſ5]? )*[A-ZÀ-Þ][\wſ'’-]*(?: [A-ZÀ-Þ][\wſ'’-]*)?"
)
_ES = re.compile(
    r"\b(?i:[cou][aun][l1i]{2}[ec]|c/|av[ec]n[il1]d[aun]|avda\.?|av\.|p[l1i][aun]z[aun]|p[l1]?za\.?|pas[ec]o|ronda|traves[ií]a|cuesta|callej[oó]n|carretera|ctra\.?|glorieta) "
    r"(?:(?:d|cl)[ec](?: [l1i][aun][sſ5]?| [l1i][o0][sſ5])? |(?:d|cl)[ec][l1i] |[l1i][aun][sſ5]? |[l1i][o0][sſ5] )*(?:[A-ZÀ-Þ][\wſ'’-]*)(?: [A-ZÀ-Þ][\wſ'’-]*){0,2}(?:, | n\.? ?[º°o]\.? ?|, n\.? ?[º°o]\.? ?| núm\.? | )\Z"
)
_ES_LETTER = re.compile(r"[ -]?[A-F]\b")


def _english(s: str, at: int) -> int:
    """End of a street name with its street word at ``at``, 0 if there is none."""
    words = 0
    while words < 5 and (w := _CAP.match(s, at)):
        word = w.group().rstrip()
        words += 1
        bare = word.rstrip(".")
        if len(bare) > 1 and bare.isupper():
            break
        if words > 1 and (bare in _STREET_SHORT or shape(bare) in _STREET_EN):
            full = word[-1] == "." and bare not in _STREET_SHORT and shape(bare) not in _ABBREVIATED
            return w.start() + len(word) - full
        if word[-1] == "." and bare not in _STREET_SHORT:
            break
        at = w.end()
    return 0


def find_addresses(s: str) -> Iterator[tuple[str, int, int]]:
    """Every address has a house number: each number is looked at with what stands before and after it."""
    spanish = any(w in s for w in (" el ", "El ", " los ", " y ", " del "))
    french = any(w in s for w in (" le ", " du ", " et ", " des ", " une "))
    for m in _HOUSE.finditer(s):
        start, end = m.span()
        if end - start == 1 and s[start] == "l":
            continue
        letter = _LETTER.match(s, end)
        after = letter.end() if letter else end
        if s[after : after + 1] == " " and (s[after + 1 : after + 2].isupper() or s[after + 1 : after + 2] in "805") and (e := _english(s, after + 1)):
            u = _UNIT.search(s, max(0, start - 16), start)
            if u and shape(re.match(r"\w+", u.group()).group()) in _UNIT_WORDS:
                start = u.start()
            yield "address", start, e
            continue
        if french and (f := _FR.match(s, end)):
            yield "address", start, f.end()
            continue
        if s[start - 1 : start] != " ":
            continue
        k = max(s.rfind(" ", 0, start - 1), s.rfind("-", 0, start - 1)) + 1
        word = s[k : start - 1].rstrip(".")
        if len(word) > 5 and word[0].isupper() and not word.isupper() and shape(word[2:]).endswith(_STREET_DE) and any(c.isdigit() for c in m.group()):
            yield "address", k, after
        elif spanish and (e := _ES.search(s, max(0, start - 56), start)):
            x = _ES_LETTER.match(s, end)
            yield "address", e.start(), x.end() if x else end


# ---- names of persons --------------------------------------------------------------------------------------------------------
_WORD = re.compile(r"(?<!\w)(?:[A-ZÀ-ÖØ-Þ](?:\.(?!\w)|[\wſ’']*(?:-[A-ZÀ-Þ][\wſ’']+)*)|[805](?:\.(?!\w)|[a-z][\wſ’']+))")


_PARTICLE = re.compile(r" (?:(?:von|van|de)(?: der| den| dem| la| las| los)?|zu|vom|zum|zur|du|des|del|della|di|da|dos|ten|ter) | d['’]")
#: Given names are learned as codes of their shapes; a bitmap of so many bits (half a megabyte) is all that is sent to the tasks.
CODES = 1 << 22
#: A word is a given name if it stood so often where only a given name can, and in so large a share of the places where it stands
#: before a capitalised word.
LEAST_SEEN, LEAST_SHARE = 2, 0.05


@lru_cache(maxsize=200_000)
def code(word: str) -> int:
    return zlib.crc32(shape(word).encode()) % CODES


def bitmap(codes: Iterable[int]) -> bytes:
    bits = bytearray(CODES // 8)
    for c in codes:
        bits[c >> 3] |= 1 << (c & 7)
    return bytes(bits)


class Words:
    """What words may be in a name, given the bitmap of learned given names; remembers up to 100,000 words."""

    def __init__(self, given: bytes | None = None):
        self.given, self.known = given, {}

    def kind(self, w: str) -> str:
        k = self.known.get(w)
        if k is None:
            if len(self.known) >= 100_000:
                self.known.clear()
            k = self.known[w] = self._judge(w)
        return k

    def _judge(self, w: str) -> str:
        """I(nitial), 8 (a digit that may be one), T(itle), G(iven name), U(nlikely as a surname), C(ommon word and surname), S(urname perhaps),
        2 (a short one perhaps), - (no part of a name)."""
        if len(w) == 2 and w[1] == ".":
            return "I" if w[0].isalpha() else "8"
        if len(w) == 1:
            return "-"
        if w.lower() in _COMMON:
            return "C"
        if w.lower() in _STOP:
            return "U"
        sh = shape(w)
        if sh in _TITLES:
            return "T"
        if sh in _FIRM_BEFORE:
            return "F"
        if self.given is not None and self.given[(c := code(w)) >> 3] >> (c & 7) & 1:
            return "G"
        if len(w) == 2 and w[1].islower():  # by shape "Li" would be "Il"
            return "2"
        if sh in _NOT:
            return "U"
        return "S" if len(w) > 2 else "-"


NOTHING_LEARNED = Words()


def _words(s: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), m.group()) for m in _WORD.finditer(s)]


def find_names(s: str, french: bool, broken: Callable[[int, int], bool] = lambda a, b: False, known: Words = NOTHING_LEARNED, words: list[tuple[int, int, str]] | None = None) -> Iterator[tuple[str, int, int]]:
    """Names by their structure (titles, initials, capitals), the words around them, and the given names ``known`` has learned.

    ``broken`` tells whether the text has a line break between two positions: there a notice may begin with a common word."""
    words = _words(s) if words is None else words
    kinds = [known.kind(w) for _, _, w in words]
    n = len(words)
    gaps = [s[words[i][1] : words[i + 1][0]] for i in range(n - 1)] + ["\n"]

    def joined(i: int) -> bool:  # word i and the next are one phrase
        return gaps[i] == " " or gaps[i] == ". " and kinds[i] == "T"

    i = 0
    while i < n:
        k = kinds[i]
        if k not in "TGIS" or k == "S" and not (gaps[i] == " " and kinds[i + 1] in "IS" or gaps[i] == ", " and kinds[i + 1] == "G"):
            i += 1
            continue
        j, titled = i, False
        while j < n - 1 and kinds[j] == "T" and joined(j):
            j, titled = j + 1, True
        first = j
        if kinds[j] == "I" and words[j][2] == "M." and french and joined(j) and j < n - 1:
            # "M." is a form of address before a bare surname, and before an initial where a place follows
            if kinds[j + 1] == "S":
                j, first, titled = j + 1, j + 1, True
            elif kinds[j + 1] in "IG" and j < n - 2 and joined(j + 1) and s[words[j + 2][1] : words[j + 2][1] + 5] == ", de ":
                j, first, titled = j + 1, j + 1, True
        given = initials = 0
        while j < n and (kinds[j] in "GI" or kinds[j] == "8" and j > first) and (j == first or joined(j - 1)):
            given += kinds[j] == "G"
            initials += kinds[j] in "I8"
            j += 1
        run_end = j
        before = words[i - 1][2] if i and gaps[i - 1] in (" ", ". ") else ""
        firm = bool(before) and not titled and shape(before.rstrip(".")) in _FIRM_BEFORE
        end = None
        # a short or common word is a surname after a form of address, a given name or initials; a street may bear a given name
        sure = j < n and (kinds[j] == "S" or kinds[j] in "2C" and (titled or j > first))
        if sure and kinds[j] in "2C":
            sure = not broken(words[j - 1][1], words[j][0])
        if sure and kinds[j] == "C":
            street = shape(words[j][2]) in _STREET_EN or words[j][2] in _STREET_SHORT
            sure = not (street and given and not titled)
        if sure and (j == first or joined(j - 1) or kinds[j - 1] == "G" and _PARTICLE.fullmatch(gaps[j - 1])):
            after = s[words[j][1] : words[j][1] + 12].split()
            if after and shape(after[0].strip(".,;")) in _FIRM_AFTER or s.startswith((" et Fils", " und ", " y C", " e Hijos"), words[j][1]):
                firm = True
            score = 0.6 * titled + 0.6 * min(given, 1) + 0.6 * min(initials, 1)
            if j == first and not titled and j < n - 1 and joined(j) and kinds[j + 1] in "IS":
                # unknown given name: believed with an initial or where the words around speak for a person
                cue = any(w in _CUES for w in _before(s, words[i][0], 24)[-2:])
                if kinds[j + 1] == "I":
                    q = j + 1
                    while q < n - 1 and kinds[q] == "I" and joined(q):
                        q += 1
                    if kinds[q] == "S" and q > j + 1:
                        score, j = 0.5 + 0.2 * cue, q
                else:
                    tail = s[words[j + 1][1] : words[j + 1][1] + 9]
                    score, j = 0.35 * cue + 0.3 * bool(re.match(r", (?:aged|[a-z\d(])| \(|\.| was| begr", tail)) + 0.3 * tail.startswith((" (+", " (0", " (5", ", aged")), j + 1
            elif titled and j == first and j < n - 1 and joined(j) and kinds[j + 1] == "S" and gaps[j] == " ":
                j += 1
            if firm:
                score -= 0.7
            if score >= THRESHOLD:
                end = words[j][1]
        if end is not None and given == initials == 0 and (words[j][2].lower() in _PLACE or j < n - 1 and joined(j) and words[j + 1][2].lower() in _PLACE):
            end = None
        if end is not None:
            yield "person_name", words[first][0], end
            i = j + 1
            continue
        # surname first: "Surname, Given I."
        if k == "S" and i < n - 1 and gaps[i] == ", " and kinds[i + 1] == "G" and not firm:
            j = i + 1
            while j < n - 1 and joined(j) and kinds[j + 1] in "IG":
                j += 1
            if not (j < n - 1 and joined(j) and kinds[j + 1] == "S") and s[words[j][1] : words[j][1] + 1] in ";,.(: ":
                yield "person_name", words[i][0], words[j][1]
                i = j + 1
                continue
        # a run of given names and initials that no surname follows is passed over at once
        i = max(i + 1, run_end if k in "GI" and not (run_end < n and kinds[run_end] == "S") else 0)


def _french(s: str) -> bool:
    return sum(map(s.count, (" le ", " la ", " du ", " des ", " et ", " une "))) > sum(map(s.count, (" the ", " of ", " der ", " die ", " und ", " el ", " en ", " y ")))


def evidence(text: str) -> tuple[list[int], list[int]]:
    """Codes of the words that stand before a capitalised word, and of those that stand where only a given name can: in a name that
    its form of address, its initials or the words around it show without any knowledge of names."""
    s = Flat(text).s
    words = _words(s)
    before = [code(w) for (_, end, w), (start, _, _) in zip(words, words[1:]) if start == end + 1 and s[end] == " " and len(w) > 2]
    sure = []
    for _, a, b in find_names(s, _french(s), words=words):
        parts = [w for w in _WORD.findall(s, a, b) if len(w) > 2]
        if s.find(",", a, b) < 0:
            sure += map(code, parts[:-1])
    return before, sure


def find(text: str, known: Words = NOTHING_LEARNED) -> list[tuple[str, int, int]]:
    """The items of a text as (kind, start, end) by code points, end exclusive, in order; no two overlap."""
    flat = Flat(text)
    s = flat.s
    french = _french(s)
    got = [*find_emails(s), *find_numbers(s), *find_addresses(s)]
    taken = sorted((a, b) for _, a, b in got)
    out = []
    last = -1
    for kind, a, b in sorted(got, key=lambda x: (x[1], -x[2])):
        if a >= last:
            out.append((kind, a, b))
            last = b
    starts = [a for a, _ in taken]
    for kind, a, b in find_names(s, french, lambda a, b: "\n" in text[slice(*flat.back(a, b))], known):
        p = bisect_right(starts, b - 1) - 1
        if p < 0 or taken[p][1] <= a:
            out.append((kind, a, b))
    return sorted(((k, *flat.back(a, b)) for k, a, b in out), key=lambda x: x[1])


def redact(text: str, items: list[tuple[str, int, int]] | None = None) -> str:
    """The text with each item replaced by ``[KIND]`` and nothing else changed."""
    parts, last = [], 0
    for kind, a, b in find(text) if items is None else items:
        parts += [text[last:a], f"[{kind.upper()}]"]
        last = b
    return "".join([*parts, text[last:]])


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[int] = Counter()
    sure: Counter[int] = Counter()

    def rows() -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64()), pa.array([sure[c] for c in seen], pa.int64())], ["code", "seen", "sure"])

    for b in batches:
        for t in b.column(0).to_pylist():
            if t:
                x, y = evidence(t)
                seen.update(x)
                sure.update(y)
        if len(seen) > 200_000:
            yield rows()
            seen.clear()
            sure.clear()
    yield rows()


def given_names(documents: DataFrame, least_seen: int = LEAST_SEEN, least_share: float = LEAST_SHARE) -> bytes:
    """The given names of a corpus, learned from all its texts, as a bitmap of ``CODES`` bits.

    No list of names is used: a word counts as a given name if at least ``least_seen`` times, and in ``least_share`` of the places where it
    stands before a capitalised word, a form of address, initials or the words around show it to be one. Tasks add their
    words up before they are shuffled; the driver sees codes only, of which there are at most ``CODES``.
    """
    n = documents.select(F.col("text").cast("string")).mapInArrow(_evidence, "code int, seen bigint, sure bigint").groupBy("code").agg(F.sum("seen").alias("seen"), F.sum("sure").alias("sure"))
    got = n.where((F.col("sure") >= least_seen) & (F.col("sure") >= least_share * F.col("seen"))).select("code").toPandas()
    return bitmap(got["code"].tolist())


def _found(batches: Iterator[pa.RecordBatch], given: bytes) -> Iterator[pa.RecordBatch]:
    known = Words(given)
    for b in batches:
        ids, kinds, starts, ends = [], [], [], []
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for kind, a, e in find(t, known) if t else ():
                ids.append(i)
                kinds.append(kind)
                starts.append(a)
                ends.append(e)
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], ["doc_id", "kind", "start_pos", "end_pos"])


def _redacted(batches: Iterator[pa.RecordBatch], given: bytes) -> Iterator[pa.RecordBatch]:
    known = Words(given)
    for b in batches:
        texts = b.column(1).to_pylist()
        items = [find(t, known) if t else [] for t in texts]
        out = [redact(t, x) if t else t for t, x in zip(texts, items)]
        yield pa.record_batch([b.column(0).cast(pa.int64()), pa.array(out, pa.string()), pa.array([len(x) for x in items], pa.int32())], ["doc_id", "text", "n_items"])


def found(documents: DataFrame, given: bytes | None = None) -> DataFrame:
    """One row per item: ``doc_id``, ``kind``, ``start_pos``, ``end_pos``. Rows are scanned where they lie, without a shuffle.

    ``given`` is a bitmap of given names (``given_names`` of a larger corpus, say); without it they are learned from these documents first,
    which scans them once more. NULL, empty and blank texts have no items; a long text is scanned whole; repeated rows give
    their items each time; other columns of the input do not matter.
    """
    given = given_names(documents) if given is None else given
    return documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(partial(_found, given=given), "doc_id bigint, kind string, start_pos bigint, end_pos bigint")


def redacted(documents: DataFrame, given: bytes | None = None) -> DataFrame:
    """``doc_id``, ``text`` with typed placeholders, ``n_items``; names as in ``found``. NULL stays NULL, empty stays empty."""
    given = given_names(documents) if given is None else given
    return documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(partial(_redacted, given=given), "doc_id bigint, text string, n_items int")
