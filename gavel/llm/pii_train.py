"""Trains the tagger on labelled spans: ``python -m gavel.llm.pii_train OUT.npz [seconds [workers [START.npz]]]``.

The labelled sentences are composed here, from general knowledge of how people write and from no table: frames of many
trades (deliveries, surgeries, schools, landlords, courts, clubs, travel, help desks, newspapers, chats) in English,
Spanish and Polish, clauses put together word by word, and loose words with details strewn in, so that a detail is told
by its own form and not by the wording around it; ordinary words come from a public tokenizer's vocabulary, read by path. Details come in every form in which they are written, beside things
that only look like them: dates, times, sums, shares, scores, ages, case and order numbers, firms, schools, places,
streets without a house number, crossings. `KEPT_OUT` has frames that training never sees; `held_out` measures on those.
"""

from __future__ import annotations

import os
import random
import re
import sys
import time

for _v in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS"):
    if __name__ == "__main__":
        os.environ[_v] = "1"

import numpy as np

from .crf import KINDS, N_TAGS, encode, fit_batch, init

FIRST = """James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph Jessica Thomas Sarah Charles Karen
Daniel Nancy Matthew Lisa Anthony Betty Mark Margaret Donald Sandra Steven Ashley Paul Kimberly Andrew Emily Joshua Donna Kenneth Michelle Kevin Carol
Brian Amanda George Dorothy Edward Melissa Ronald Deborah Jason Stephanie Ryan Rebecca Jacob Laura Gary Helen Eric Amy Larry Anna Frank Brenda Scott
Pamela Raymond Emma Gregory Nicole Samuel Katherine Patrick Virginia Jack Rachel Dennis Carolyn Jerry Janet Oliver Amelia Noah Isla Mia Ethan Chloe Lucas
Priyanka Arjun Deepa Rahul Ananya Vikram Kwame Abena Kofi Ama Chidi Ngozi Amina Fatima Mohammed Yusuf Ahmed Leila Omar Zainab Hassan Wei Mei Jun Xiu Hiroshi
Yuki Kenji Sakura Min Ji Soo Thanh Linh Nguyen Duc Maria Jose Carmen Juan Rosa Luis Guadalupe Francisco Ignacio Beatriz Diego Lucia Pablo Ines Javier
Marta Sofia Mateo Camila Rafael Teresa Jerzy Malgorzata Aleksander Stanislaw Katarzyna Piotr Agnieszka Tomasz Zofia Wojciech Ewa Krzysztof Joanna Marek
Hans Greta Klaus Ursula Jurgen Heidi Pierre Amelie Luc Chantal Giulia Marco Paola Enzo Ivan Olga Dmitri Natasha Sergei Irina Lars Ingrid Sven Astrid Niamh
Sean Ciaran Siobhan Bob Bill Liz Kate Tom Mike Dave Jim Joe Sue Ed Tony Nick Pete Ben Sam Max Leo Ruth Eva Ivy Zoe Nora Hugo Felix Bruno Conrad Basil""".split()
LAST = """Smith Johnson Williams Brown Jones Miller Davis Wilson Anderson Taylor Moore Jackson Martin Lee Thompson White Harris Clark Lewis Robinson Walker Young
Allen King Wright Scott Hill Green Adams Baker Nelson Carter Mitchell Perez Roberts Turner Phillips Campbell Parker Evans Edwards Collins Stewart Morris
Garcia Martinez Rodriguez Lopez Gonzalez Hernandez Sanchez Ramirez Torres Flores Rivera Gomez Diaz Cruz Reyes Morales Ortiz Vargas Castillo Chatterjee Patel
Sharma Gupta Khan Singh Kumar Iyer Nair Chen Wang Li Zhang Liu Yang Huang Kim Park Choi Nguyen Tran Pham Tanaka Suzuki Sato Watanabe Mensah Okafor Adeyemi
Boateng Nkrumah Diallo Hussein Rahman Haddad Nasser Kowalski Nowak Wisniewski Lewandowski Zielinski Mazur Muller Schmidt Schneider Fischer Weber Hoffmann
Dubois Moreau Laurent Rossi Ferrari Bianchi Novak Horvat Petrov Ivanov Sokolov Johansson Nilsson Hansen Larsen Murphy Kelly Byrne Doyle Walsh Papadopoulos""".split()
PARTICLES = ["van ", "van der ", "de ", "de la ", "del ", "da ", "von ", "di ", "al-", "El ", "O'", "Mc", "Mac", "St. ", "le "]
TITLES = ["Mr.", "Mrs.", "Ms.", "Dr.", "Mx.", "Mr", "Mrs", "Ms", "Dr", "Hon.", "Sen.", "Rev.", "Prof.", "Sr.", "Sra.", "Rep.", "Judge", "Officer", "Captain", "Sgt.", "Councilmember", "Mayor", "Sir", "Pani", "Pan", "Señora", "Nurse", "Coach", "Miss"]
KIND_WORDS = {"Street": ["St.", "St", "Str.", "Street"], "Avenue": ["Ave.", "Ave", "Av", "Av.", "Avenue"], "Road": ["Rd.", "Rd", "Road"], "Drive": ["Dr.", "Dr", "Drive"], "Place": ["Pl.", "Pl", "Place"],
    "Court": ["Ct.", "Ct", "Court"], "Terrace": ["Terr.", "Ter", "Ter.", "Terrace"], "Boulevard": ["Blvd.", "Blvd", "Boulevard"], "Lane": ["Ln.", "Ln", "Lane"], "Square": ["Sq.", "Square"], "Way": ["Way"], "Parkway": ["Pkwy", "Parkway"]}
DIRS = {"North": ["N.", "N", "No.", "North"], "South": ["S.", "S", "So.", "South"], "East": ["E.", "E", "East"], "West": ["W.", "W", "West"]}
ORDINALS = "First Second Third Fourth Fifth Sixth Seventh Eighth Ninth Tenth Eleventh Twelfth".split()
STREET_NAMES = "Main Oak Maple Cedar Elm Pine Washington Lake Hill Walnut Spring River Park Church Bridge Mill Forest Highland Union Liberty Franklin Jackson Lincoln Chestnut Willow Garden Station Market Prospect Grove".split()
ADJ = "Green Blue Old Golden Royal Happy Sunny Iron Stone Red Bright Modern Prime Global United Central Pacific Alpine Swift Noble Brave Clever Fancy Gentle Jolly Lively Merry Plain Rapid Sharp Urban Vivid Warm Young Zesty Crimson Dusty Frosty Hidden Lone".split()
NOUN = "Dragon Lion Rose Crown Bell Harbor Garden Mountain Valley Tiger Eagle Falcon Wolf Bear Fox Horse Star Moon Sun Cloud River Bridge Tower Gate Castle Field Orchard Meadow Pearl Diamond Arrow Shield Hammer Wheel Clock Book Pen Lamp Spoon Whale".split()
FIRM = ["Dental Clinic", "Insurance", "Robotics", "Consulting", "Motors", "Pharmacy", "Hardware", "Travel", "Logistics", "Bank", "Airlines", "Books", "Restaurant", "Hotel", "Inn", "Diner", "Pub", "Coffee", "Pizzeria", "Fitness", "Law Group", "& Sons", "& Co.", "Studios", "Plumbing", "Foods",
    "Media", "Systems", "Laundry", "Florist", "Records", "Theatre", "Gallery", "Supermarket", "Brewery", "Spa", "Salon", "Garage", "Bakery", "Bar", "Grill", "Kitchen", "Cafe", "Deli", "Social Club", "Lounge"]
BODY = ["Association", "Society", "Union", "Foundation", "Council", "League", "Alliance", "Committee", "Federation", "Trust", "Institute", "Network", "Coalition", "Club", "Initiative", "Center", "Fund", "Partnership", "Project", "Guild"]
FIELD = ["Housing", "Wildlife", "Youth", "Tenants", "Merchants", "Arts", "Neighborhood", "Veterans", "Teachers", "Parents", "Heritage", "Cycling", "Garden", "Rowing", "Chess", "Literacy", "Health", "Music", "Film", "Block", "Business", "Civic", "Community", "Trade"]
SITE = ["School", "Elementary School", "High School", "Library", "Hospital", "Park", "Playground", "University", "College", "Museum", "Airport", "Station", "Stadium", "Church", "Pool", "Community Center", "Bridge", "Plaza", "Theater", "Recreation Center"]
TOPIC = """the broken lift|late invoices|the school trip|parking fees|a missing parcel|the winter timetable|the leaking roof|a refund|blood test results|the summer camp|garden waste|the office move|overtime pay|a lost umbrella
the new software|bus delays|the bicycle shed|noise at night|the kitchen renovation|tax forms|a wedding cake|the football match|swimming lessons|the concert|the annual report|his pension|her passport renewal|the insurance claim
street lighting|the water bill|tree planting|dog licences|the playground swings|loud music|traffic near the hospital|rubbish collection|the library's opening hours|a building permit|rats in the cellar|snow on the pavement|the market stalls|a bar licence|the tenants' meeting|cheaper flats""".replace("\n", "|").split("|")
CITY = "Springfield London Madrid Warsaw Chicago Boston Lagos Berlin Paris Toronto Sydney Mumbai Oakland Denver Austin Kraków Sevilla Dublin Leeds Osaka Albany Trenton".split()
FRAMES = """Parcel for {name}, {addr}, was left with the neighbour.
Please deliver the sofa to {addr} before {time}; the buyer is {name}.
Courier note: nobody home at {addr}, rang {phone} twice.
Order {case} was shipped to {name} on {date}.
Invoice {case} for {money} remains unpaid by {biz}.
Dear {name}, thank you for writing to us about {topic}.
Hi {first0}, could you call {phone} today?
Hi team, {name} is out sick until {day}.
Hello all, the meeting about {topic} moves to {date}.
this is {name} from accounts, my extension changed
Regards, {name}, {biz}
Best wishes,\n{name}\n{phone}\n{email}
{name} <{email}> wrote:
From: {email} To: {email} Subject: {topic}
cc {email}, {email}
You can reach me at {email} or on {phone}.
My mobile is {phone} and my work address is {email}.
Fax {phone}, attention {name}.
Tel. {phone} | {email} | {addr}
Patient {name}, seen on {date}, complained about headaches.
Next appointment: {name}, {date}, {time}.
Emergency contact: {name} ({rel}), {phone}.
Insurance card issued to {name}; {id}.
The nurse wrote down {id} for {name}.
Blood pressure of {n} over {n} was recorded by {name}.
Pupil {name} of {site} won the prize in {date}.
{name} and {name} will drive the children to {site}.
Parents may write to {email} about {topic}.
The rent for {addr} is {money} a month.
Tenant {name} moved out of {addr} on {date}.
Landlord: {name}. Deposit: {money}. Keys: two.
A flat at {addr} was let to {name} and {name}.
Water was off at {addr} for {n} hours.
Case {case}: {name} against {biz}.
Witness {name} lives at {addr}.
The court heard {name} on {date} and {name} on {date}.
Judge {last0} asked counsel about {topic}.
Mr. {last0} and Ms. {last0} signed the lease.
The applicant gave {id} and a copy of the lease.
He showed {id} at the counter of {biz}.
{id} belongs to {name}.
Employee {name}: {id}; start {date}; salary {money}.
Do not share {id} by mail.
Wire {money} to {biz}, reference {case}.
The {org} elected {name} as treasurer.
{name}, chair of the {org}, praised {topic}.
{name} of the {org} could not come.
{poss} car was parked on {street}.
{poss} daughter goes to {site}.
{poss} lawyer sent a fax from {phone}.
We spoke with {poss} sister about {topic}.
"{topic} is my only worry," said {name}.
{name} said: "I will call you back on {phone}."
{name} asked whether {topic} would cost more than {money}.
{name} scored twice; the match ended {score}.
{name} beat {name} {score} in {city}.
According to {name}, {pct} of members agreed.
{pct} of the staff at {biz} voted for {topic}.
The vote was {score} with {n} abstentions.
Since {year} {name} has led the choir.
In {year}, {name} opened {biz} on {street}.
{name} ({year}-{year}) painted {site}.
{name}, {n}, of {city}, was arrested on {street}.
Police are looking for {name}, last seen near {cross}.
The driver, {name}, was taken to {site}.
Two cars met at {cross} around {time}; no one was hurt.
A cyclist fell on {street}. Report {case}.
Firefighters were called to {addr} at {time}.
Officer {last0} took a statement from {name}.
Taxi from {addr} to {addr} for {name}.
Flight {case} leaves {city} at {time}.
Booking for {name}, {n} guests, {date}.
Guest: {name}; room {n}; call {phone}.
Tickets for {topic} are sold at {biz}, corner of {cross}.
Meet me at {biz} near {cross}, {time}.
The shop {biz} on {street} closes in {date}.
{biz} hired {name} and {name}.
{biz}, {addr}, open daily.
Branch: {addr}. Manager: {name}.
Donations were made by {name}, {name} and {biz}.
Thanks to {name}, {name}, and the {org}!
{name}; {name}; {name}
{name} - absent
{name} (excused), {name} (late)
{name}, secretary
{first0} {first0} and the others left early.
{name}: yes. {name}: no.
{name} - in favour. {name} - against {topic}.
Q: where do you live? A: at {addr}, with {name}.
Agent: your number please? Caller: {phone}.
ok {first0} send it to {email} thx
lol {name} lost his keys again at {biz}
@{first1} see you at {time}, my new number: {phone}
Lost cat near {cross}. Please ring {phone}.
For sale: bike, {money}, {phone}, ask for {name}.
Wanted: room near {site}. Write to {email}.
Members: {name}, {addr}; {name}, {addr}.
Name: {name}  Address: {addr}  Phone: {phone}
Name {name} Date {date} Signature
Applicant | {name} | {addr} | {email}
{n}. {name}, {addr}
{name}\t{phone}\t{email}
P.O. Box {n}{n}, {city}
Page {n} of {n}. Item {n}: {topic}.
Agenda for {date}: {topic}; {topic}; any other business.
Permit {case} expires on {date}.
Complaint {case} about {topic} was closed.
See file {case} and the letter of {date}.
The {org} met at {site} on {date} at {time}.
The {org} and {biz} share an office on {street}.
Nobody from {biz} replied about {topic}.
A man in his forties asked about {topic}.
An elderly woman fell outside {biz} on {street}.
A {n}-year-old boy was hurt near {site}.
The speaker gave no name and talked about {topic}.
The victim, {name}, {n}, lived at {addr}.
Mourners remembered {name} at {site}.
Flowers may be sent to {addr}; questions to {email}.
Me llamo {name} y vivo en {addr}.
La señora {name} pidió hora para el {n} de mayo.
Llame al {phone} o escriba a {email}.
El paquete de {name} está en {addr}, tel. {phone}.
La factura {case} de {biz} suma {money}.
Don {name} y su hija {first0} llegaron tarde.
Según {name}, el {pct} está de acuerdo con el horario.
El vecino {name} se quejó del ruido en {street}.
Mam na imię {first0}, mój numer to {phone}.
Paczka dla {name}, {addr}, telefon {phone}.
Proszę pisać na {email} albo dzwonić pod {phone}.
Pan {name} prosił o fakturę {case} do {n} maja.
Pani {last0} mieszka przy {addr}.
Zebranie w sprawie remontu: {date}, godz. {time}.
Zgłosił się {name}, pesel w aktach, {id}.
{word}: {name}, {word} {addr}
{word} {word}: {name}, {word} {phone}
{Word} {word} {name} {word} {word}.
{Word} {word} by {name}, {word} {word}
{Word} {word} to {name} and {name}
"{word} {word} {word}" ({name}, {org})
{name} and {name} {word} {word}
{name} {word} {word} {word}, {word} {word}.
{name} {word} {word} {phone}
{name} {word} {id} {word} {word}
{name} - {word}. {Word} {word}
{Word} {word}
{Word} {word} {word}
{email}
{phone}
{addr}
{name}
{name}
{name}
{name}
{name}
{name}
{name}
{name}
{name} / {id}
{name} / {phone}
{name}, {n}
{name}, of {addr}
{name} - {phone}
{name} [{phone}]
{name}, {n}
{name} ({rel})
{name}, of {addr}
{name} & {name}
{name} c/o {name}
{name} / {phone}
{name} [{id}]
{name} and {n} others
{name} (pedestrian), {name} (driver)
adult male, {n}
boy of {n}
girl ({n})
no name given
name withheld
unidentified
not known yet
driver and two riders
a scooter rider
elderly man with a cane
mother and baby
{n}-year-old student
woman, about {n}
the postman
group of hikers""".split("\n")
SUBJECT = ["{name}", "{name}", "{name}", "{name} of {org}", "{name} ({org})", "the owner of {biz}", "she", "he", "they", "we", "a neighbour", "{org}", "{biz}", "the tenant at {addr}", "a caller from {addr}", "{poss} brother", "someone", "the clerk", "{name} and {name}", "staff", "a resident", "the chair", "nobody"]
VERB = ["spoke about", "complained of", "asked for", "wrote about", "opposed", "supported", "was glad of", "knew nothing of", "explained", "objected to", "thanked everyone for", "voted against", "is worried about", "praised", "reported", "described", "mentioned", "wanted more on", "is for", "is against", "brought photos of", "heard of", "presented", "signed for", "noted", "testified on"]
TAIL = ["", "", "", ".", " and left {phone}.", " and gave {addr}.", ", {email}.", " near {cross}.", " at {site}.", " on {date}.", "; call {phone}.", " (see {case}).", " for {org}.", " with {name}.", ", said {name}.", " outside {biz}.", " from {email}.", " in a letter of {date}.", " by {time}.", " on {street}.", ", who lives at {addr}.", " because of {topic}.", " and showed {id}.", " - {pct} agreed.", " for {n} minutes.", ", {score}."]
FILL = """the a our that this some every no one and but then so with without after before during about for against on in from over under while because if when we they she he it who which
box letter hour cake budget trees corner train school book bench ticket weather water garden lights soup chair report office clerk window street bus delay repair garage question answer table
said asked wrote called told brought showed gave took left heard wants needs opened closed signed waited lost found again later today very still only more never often maybe
que con para por una casa calle pero cuando muy también dijo w na z do nie jest był sprawie ulicy proszę""".split()
JOIN = {"name": ["", "", "by ", "from ", "with ", "for ", "and ", "to ", "of ", "con ", "dla "], "addr": ["at ", "near ", "of ", "from ", "outside ", "to ", "en ", "", "przy "], "phone": ["at ", "on ", "call ", "tel. ", "phone ", "from ", "", "cell ", "ph: "], "email": ["at ", "to ", "via ", "mail ", "from ", "", "e-mail: "],
    "id": ["", "with ", "has ", "showed "], "case": ["case ", "file ", "no. ", "docket ", "order ", "permit ", "report ", "complaint "], "org": ["for ", "of ", "from ", "the "], "site": ["at the ", "near the ", "at ", "by "], "biz": ["at ", "outside ", ""], "cross": ["at ", "near ", "by "], "street": ["on ", "along ", ""],
    "date": ["on ", "until ", ""], "time": ["at ", "by "], "money": ["for ", ""], "pct": ["", "about "], "year": ["in ", "since ", ""], "score": ["", "by "], "n": ["", "page ", "room "], "city": ["in ", "from "]}
RELATION = ["mother", "wife", "son", "sister", "neighbour", "uncle", "via phone", "on Zoom", "by video", "witness", "deceased", "owner", "cyclist", "passenger"]
#: Ranks of a public tokenizer of many languages: its whole words, less the names above, serve as ordinary words.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
_R = random.Random()


def ordinary(path: str = VOCABULARY) -> list[str]:
    """Words of four letters and more that stand alone in a vocabulary, in lower case; the short list where there is no file."""
    import base64

    if not os.path.isfile(path):
        return FILL
    names = {w.lower() for w in FIRST + LAST}
    with open(path, "rb") as f:
        raw = [base64.b64decode(line.split()[0]) for line in f]
    words = (r.decode("utf-8", "ignore") for r in raw if r[:1] == b" ")
    return sorted({w[1:] for w in words if w[1:].isalpha() and w[1:].islower() and len(w) > 4 and w[1:] not in names})


WORDS: list[str] = []


def _plain() -> str:
    """An ordinary word."""
    if not WORDS:
        WORDS.extend(ordinary())
    return _R.choice(WORDS) if _R.random() < 0.6 else _R.choice(FILL)


def _loose() -> str:
    """A frame of loose words with details strewn in, so that no wording is needed to tell one."""
    out = []
    for _ in range(_R.randrange(1, 4)):
        out += [_plain() for _ in range(_R.randrange(0, 7))]
        kind = _R.choice([*JOIN, "name", "name", "name", "addr", "addr", "phone", "phone", "email", "id"])
        out.append(_R.choice(JOIN[kind]) + "{" + kind + "}" + _R.choice(["", "", "", ",", ".", ";", ":", " -", ")"]))
    out += [_plain() for _ in range(_R.randrange(0, 5))]
    if _R.random() < 0.3:  # headings and words at the start of a sentence have capitals too
        k = _R.randrange(len(out))
        out[k] = out[k][0].upper() + out[k][1:] if out[k][0].isalpha() and "{" not in out[k] else out[k]
    s = " ".join(out)
    return (s[0].upper() + s[1:] if s[0] != "{" and _R.random() < 0.7 else s) + _R.choice([".", ".", "", "!", "?"])


def _clause() -> str:
    subject, verb = _R.choice(SUBJECT), _R.choice(VERB)
    if _R.random() < 0.3:
        subject = f"{_R.choice(['the ', 'a ', 'one ', ''])}{_plain()}"
    if _R.random() < 0.4:
        verb = f"{_plain()}{_R.choice([' ', ' the ', ' ' + _plain() + ' ', ', '])}".rstrip()
    s = f"{subject} {verb} {{topic}}{_R.choice(TAIL)}"
    if _R.random() < 0.1:
        s = _R.choice(["Note: ", "Re: ", "Comment: ", "Today ", "Then ", "Later ", "Read aloud: ", "Email: ", "Transcript: ", "Form: "]) + s
    return s[0].upper() + s[1:]


def _word(parts: int | None = None) -> str:
    on = "B D F G H J K L M N P R S T V W Z Br Cr Dr Fr Gr Kr Pr Tr Vr St Sk Sp Pl Cl Gl Sl C Ch Sh Th Y A E I O U".split()
    mid = "b d f g k l m n p r s t v z br dr gr kr pr tr vr st sk lb lk lm lt ld nd nt ng rk rm rn rt rv ch sh th zh ph w ss ll nn".split()
    end = "n r l s x dt ck sh th m d man ley berg feld dal nez lin ton dex mar way ski vos rett der gh ny max ver mes ric wood son ska wicz ez es ov ova sen ini ano ard sworth field ham by".split()
    w = _R.choice(on)
    w += "" if w[-1] in "AEIOU" else _R.choice("aeiou")
    for _ in range(parts if parts is not None else _R.choice((0, 1, 1, 2, 2, 3))):
        w += _R.choice(mid) + _R.choice("aeiou")
    return w + _R.choice(end)


def _typo(w: str) -> str:
    if len(w) < 4 or _R.random() > 0.12:
        return w
    i = _R.randrange(1, len(w) - 1)
    return _R.choice([w[:i] + w[i + 1 :], w[:i] + w[i] + w[i:], w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[:i] + _R.choice("abcdeiort1") + w[i + 1 :], w[:i] + " " + w[i:] if _R.random() < 0.3 else w])


def _case(s: str) -> str:
    r = _R.random()
    return s.upper() if r < 0.07 else s.lower() if r < 0.14 else s


def _first() -> str:
    return _R.choice(FIRST) if _R.random() < 0.7 else _word(_R.choice((0, 1)))


def _last() -> str:
    w = _R.choice(LAST) if _R.random() < 0.3 else _word()
    r = _R.random()
    return _R.choice(PARTICLES) + w if r < 0.06 else f"{w}-{_word(0)}" if r < 0.1 else f"{w} {_R.choice(LAST)}" if r < 0.12 else w


def _name() -> list[tuple[str, str]]:
    f, last = _typo(_first()), _typo(_last())
    r = _R.random()
    mid = f" {chr(65 + _R.randrange(26))}." if _R.random() < 0.15 else f" {chr(65 + _R.randrange(26))}" if _R.random() < 0.03 else f" {_first()}" if _R.random() < 0.05 else ""
    if r < 0.12:
        core, bare = last, True
    elif r < 0.24:
        core, bare = f"{last}, {f}{mid}", False
    elif r < 0.27:
        core, bare = f"{last} {f}", False
    elif r < 0.36:
        core, bare = f"{f[0]}. {last}" if _R.random() < 0.8 else f"{last}, {f[0]}.", False
    else:
        core, bare = f"{f}{mid} {last}", False
    core = _case(core)
    title = ""
    if _R.random() < (0.75 if bare else 0.15):
        title = _R.choice(TITLES) + " "
        title = title.upper() if core.isupper() else title.lower() if core.islower() else title
    after = _R.choice(["", *[""] * 24, ", Esq.", ", PhD", " Jr.", " (via Zoom)", ", MD", " III"])
    return [(title, ""), (core, "name"), (after, "")]


def _dir() -> str:
    return _R.choice(DIRS[_R.choice(list(DIRS))])


def _street() -> str:
    n = _R.randrange(1, 13)
    if _R.random() < 0.25:
        name = _R.choice([ORDINALS[n - 1], f"{n}{'st' if n == 1 else 'nd' if n == 2 else 'rd' if n == 3 else 'th'}", f"{n} th", str(n)])
    else:
        name = _typo(_word()) if _R.random() < 0.7 else _R.choice(STREET_NAMES)
    kind = _R.choice(KIND_WORDS[_R.choice(list(KIND_WORDS))])
    r = _R.random()
    if r < 0.3:
        return f"{_dir()} {name} {kind}"
    if r < 0.4:
        return f"{name} {kind} {_dir()}"
    if r < 0.44:
        return name
    return f"{name} {kind}"


def _addr() -> str:
    n = _R.choice([f"{_R.randrange(1, 1000)}", f"{_R.randrange(1, 1000)}", f"{_R.randrange(1, 1000)}{_R.choice('ABC')}", f"{_R.randrange(1, 999)}-{_R.randrange(1, 99):02d}", f"{_R.randrange(1000, 20000)}"])
    unit = _R.choice(["", "", "", f" Apt. {_R.randrange(1, 20)}{_R.choice(['', 'A', 'B', 'C'])}", f", Apt {_R.randrange(1, 20)}", f" #{_R.randrange(1, 20)}", f", Unit {_R.randrange(1, 20)}", f", Suite {_R.randrange(1, 20)}", f" Fl. {_R.randrange(2, 9)}"])
    return _case(f"{n} {_street()}{unit}")


def _cross() -> str:
    return f"{_street()}{_R.choice([' & ', ' and ', ' / ', ' @ ', ' at '])}{_street()}"


def _phone() -> str:
    a, b, c = _R.choice(["212", "718", "917", "646", "347", "929", "202", "312"]), _R.choice(["555", "555", f"{_R.randrange(200, 999)}"]), f"{_R.randrange(10000):04d}"
    digit = lambda s: " ".join({"0": "oh"}.get(x, "zero one two three four five six seven eight nine".split()[int(x)]) for x in s)
    return _R.choice([f"{a}-{b}-{c}", f"({a}) {b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"{a}{b}{c}", f"{a}/{b}-{c}", f"+1 {a} {b} {c}", f"+1({a}){b}{c}", f"1-{a}-{b}-{c}", f"{b}-{c}", f"{a} - {b} - {c}", f"({a}){b}.{c}",
        f"+44 20 7946 {c}", f"{digit(b)}, {digit(c)}", f"{digit(b)} {digit(c)}", f"+48 {_R.randrange(500, 900)} {b} {c[:3]}",
        f"020 7946 {c}", f"0{_R.randrange(1000, 2000)} {_R.randrange(100000, 999999)}", f"+34 {_R.randrange(600, 700)} {b} {c[:3]}", f"+91 {_R.randrange(70000, 99999)} {_R.randrange(10000, 99999)}", f"({a}) {b} {c}", f"1 ({a}) {b}-{c}", f"+1-{a}-{b}-{c}", f"{a}-{b} {c}", f"{digit(a)} {digit(b)} {digit(c)}", f"{digit(a)}, {digit(b)}, {digit(c)}", f"{a} {b}-{c}", f"{a}.{b}{c}"])


def _email() -> str:
    f, last, n = _first().lower(), _word().lower(), _R.randrange(1, 99)
    user = _R.choice([f"{f}.{last}", f"{f}_{last}", f"{f[0]}{last}", f"{last}{n}", f"{last}.{f[0]}", f"{f}+board", f, f"{f}{n}"])
    host = _word().lower() + _R.choice(["", "mail", "net", "-post"])
    tld = _R.choice([["example"], ["mail", "example"], ["example", "org"], ["test"], ["invalid"], ["com"], ["org"], ["net"], ["gov"], ["co", "uk"]])
    r = _R.random()
    if r < 0.1:
        return f"{user} at {' dot '.join([host, *tld])}"
    if r < 0.16:
        return f"{user}@{' . '.join([host, *tld])}"
    if r < 0.22:
        return f"{user} @ {'.'.join([host, *tld])}"
    if r < 0.29:
        at = _R.choice(["(at)", " (at) ", "[at]", " [at] ", " (a) ", "(a)", "[a]", " [a] ", "{at}", " AT ", " at ", "_at_"])
        return f"{user}{at}{'.'.join([host, *tld])}"
    if r < 0.33:
        at, dot = _R.choice([(" [at] ", " [dot] "), ("[at]", "[dot]"), (" (at) ", " (dot) "), ("(at)", "(dot)"), (" @ ", " . "), (" AT ", " DOT "), (" (a) ", " . "), (" arroba ", " punto "), (" małpa ", " kropka ")])
        return f"{user}{at}{dot.join([host, *tld])}"
    s = f"{user}@{'.'.join([host, *tld])}"
    return s.upper() if _R.random() < 0.12 else s


def _id() -> list[tuple[str, str]]:
    d = lambda n: "".join(_R.choice("0123456789") for _ in range(n))
    ssn = _R.choice([f"{d(3)}-{d(2)}-{d(4)}", f"{d(3)} {d(2)} {d(4)}", d(9)])
    label, num = _R.choice([
        (_R.choice(["SSN", "SS no.", "Social Sec. #", "social", "social security number", "soc. sec. no."]), ssn),
        (_R.choice(["SSN", "ssn", "Social Security", "Social Security No.", "soc sec", "SS#", "social security #"]), ssn),
        (_R.choice(["DL#", "driver license", "driver's license no.", "license no."]), f"{_R.choice('KVDMSB')}{d(2)}-{d(3)}-{d(3)}"),
        (_R.choice(["passport", "passport no.", "Passport #", "passport number", "pasaporte", "paszport"]), f"{_R.choice('QXZCA')}{d(7)}"),
        (_R.choice(["city ID card", "city ID", "ID card no."]), f"{d(4)} {d(4)} {d(4)}"),
        (_R.choice(["national ID", "national ID no.", "nat. ID"]), f"{_R.choice(['QK', 'PX', 'RB', 'ZT'])}-{d(8)}"),
        (_R.choice(["PESEL", "DNI", "NIE"]), _R.choice([d(11), f"{d(8)}{_R.choice('ABCDEFZ')}", f"X{d(7)}{_R.choice('ABCDEFZ')}"]))])
    return [(_case(label) + _R.choice([" ", " ", " ", ": ", " is ", " - ", " number ", "=", " ("]), ""), (num, "id_number")]


def _case_no() -> str:
    d = lambda n: "".join(_R.choice("0123456789") for _ in range(n))
    up = lambda n: "".join(chr(65 + _R.randrange(26)) for _ in range(n))
    return _R.choice([f"20{d(2)}-{d(4)}", f"{d(3)}-{d(2)}-{up(2)}", f"{up(2)} {d(3)}-{d(4)}", f"{up(1)}{d(6)}{up(1)}", d(10), f"{up(3)}-{d(5)}", f"#{d(6)}", f"{d(4)}/{d(2)}", d(7), f"{up(2)}{d(4)}", f"{d(2)}-{d(5)}", f"{d(4)}-{d(2)}", f"{up(1)}-{d(3)}"])


def _date() -> str:
    y, m, d = _R.randrange(1990, 2030), _R.randrange(1, 13), _R.randrange(1, 29)
    month = "January February March April May June July August September October November December".split()[m - 1]
    return _R.choice([f"{m}/{d}/{y}", f"{m}/{d}/{y % 100:02d}", f"{y}-{m:02d}-{d:02d}", f"{d}.{m}.{y}", f"{month} {d}, {y}", f"{month} {d}", f"{d} {month} {y}", f"{month} {y}", month, f"{month[:3]}. {d}", f"{m}-{d}-{y % 100:02d}", f"{d}/{m}/{y}"])


def _score() -> str:
    a, b, c = _R.randrange(0, 40), _R.randrange(0, 12), _R.randrange(0, 6)
    return _R.choice([f"{a}-{b}", f"{a} to {b}", f"{a}-{b}-{c}", f"{a}-{b}-{c}-{b}", f"{a}:{b}"])


def _org() -> str:
    p, f, k = _R.choice([_typo(_word()), _typo(_word()), _R.choice(CITY), _R.choice(STREET_NAMES), _R.choice(LAST)]), _R.choice(FIELD), _R.choice(BODY)
    short = f"{f[0]}{k[0]}"
    return _case(_R.choice([f"{p} {f} {k}", f"{p} {f} {k}", f"{p} {k}", f"The {p} {f} {k}", f"{f} {k} of {p}", f"{k} for {f}", f"{f} {k}, {p}", f"{p} {f} {k}, Inc.", f"{p} {short}", f"{p} {f} {k} ({short})", f"{p} {f} {k[:4]}.", f"{f} {k}", f"Friends of {p}", f"{p} {f} & {_R.choice(FIELD)} {k}"]))


def _biz() -> str:
    a, n, f = _R.choice(ADJ), _R.choice(NOUN), _R.choice(FIRM)
    return _case(_R.choice([f"{a} {n} {f}", f"The {a} {n}", f"{n} {f}", f"{_R.choice(LAST)} {f}", f"{_word()} {f}", f"{_R.choice(FIRST)}'s {f}", f"{a} {f}", f"{n} & {_R.choice(NOUN)} {f}", f"{_word()} {f} LLC", f"The {a} {n} {f}", f"{a} {n}", f"{_word()} {_R.choice(FIRM)}, Inc."]))


def _site() -> str:
    s = _R.choice(SITE)
    return _R.choice([f"{_first()} {_last()} {s}", f"{_word()} {s}", f"{_R.choice(STREET_NAMES)} {s}", f"St. {_first()} {s}", f"{_word()} Square {s.lower()}", f"PS {_R.randrange(1, 300)}", f"the {s.lower()}", f"{_R.choice(CITY)} {s}", f"{_last()} Memorial {s}"])


#: What fills a slot that is no detail.
OTHER = {
    "cross": lambda: _cross(), "org": lambda: _org(), "site": lambda: _site(), "case": lambda: _case_no(), "topic": lambda: _R.choice(TOPIC) if _R.random() < 0.4 else " ".join(_plain() for _ in range(_R.randrange(1, 5))), "biz": lambda: _biz(), "n": lambda: str(_R.randrange(1, 100)), "date": lambda: _date(), "year": lambda: str(_R.randrange(1900, 2030)),
    "time": lambda: _R.choice([f"{_R.randrange(1, 13)}:{_R.randrange(60):02d}", f"{_R.randrange(1, 13)} {_R.choice(['am', 'p.m.', 'PM'])}", f"{_R.randrange(24)}:{_R.randrange(60):02d}", "noon"]), "day": lambda: _R.choice("Monday Tuesday Wednesday Thursday Friday Saturday Sunday".split()),
    "money": lambda: _R.choice([f"${_R.randrange(1, 999)}", f"${_R.randrange(1, 99)},{_R.randrange(1000):03d}", f"{_R.randrange(1, 999)} euros", f"{_R.randrange(10, 9999)} zł", f"${_R.randrange(1, 99)}.{_R.randrange(100):02d}"]), "pct": lambda: f"{_R.randrange(1, 100)}{_R.choice(['%', ' percent', ' per cent'])}",
    "word": lambda: _plain(), "Word": lambda: _plain().capitalize(), "score": lambda: _score(), "street": lambda: _street(), "city": lambda: _R.choice(CITY), "rel": lambda: _R.choice(RELATION),
}


def sentence(frame: str) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    for part in re.split(r"(\{\w+\})", frame):
        slot = part[1:-1] if part.startswith("{") else ""
        if not slot:
            out.append((part, ""))
        elif slot == "name":
            out += _name()
        elif slot == "poss":
            out += [_name()[1], (_R.choice(["'s", "'s", "’s"]), "")]
        elif slot in ("first0", "last0"):
            out.append((_first() if slot == "first0" else _last(), "name"))
        elif slot == "first1":
            out.append((_first().lower() + str(_R.randrange(10, 99)), ""))
        elif slot == "id":
            out += _id()
        elif slot == "phone":
            out.append((_phone(), "phone"))
        elif slot == "email":
            out.append((_email(), "email"))
        elif slot == "addr":
            out.append((_addr().rstrip("."), "address"))
            if _R.random() < 0.3:
                out.append((".", ""))
        else:
            out.append((OTHER[slot](), ""))
    return out


#: Frames that training never sees.
KEPT_OUT = """The piano tuner {name} comes to {addr} every spring.
Returned mail: {email} is unknown, try {email} instead.
Vet record: rabbit of {name}, weighed {n} g on {date}.
Our guide, {name}, waited by {cross} until {time}.
To book a boat write to {email} or ring {phone} after {time}.
{name} lost {id} on the ferry and asked the purser for help.
The choir of {site} thanks {name} and {name} for the cake.
Storm damage at {addr}: two windows, {money}.
Chess club: {name} - {name} {score}; {name} did not play.
{biz} moved from {street} to {addr}.
I bought my bike from {name}, {phone}, for {money}.
Ms. {last0} teaches at {site}; her room is {n}.
The plumber sent by {biz} never rang the bell at {addr}.
Please forward this to {name} ({email}) and to the {org}.
In the photo of {year}: {name}, {name} and an unknown sailor.
Ship to: {name}, {addr}
Score sheet {case}: judges {name}, {name}.
A tourist asked {name} for the way to {cross}.
{pct} of the seats were sold, wrote {name} in {year}.
Reference for {name}: honest, punctual, {n} years with {biz}.
Baggage tag {case}, owner {name}, hotel near {site}.
She dictated her number, {phone}, and {id}.
La profesora {name} vive cerca de {site}; correo {email}.
Lekarz {name} przyjmuje przy {addr}, telefon {phone}.""".split("\n")
TRAINING = FRAMES


def sample(frames: list[str] | None = None) -> tuple[str, list[int]]:
    """A text and the tag of each character. frames: only these, one or two of them."""
    if frames:
        parts = sentence(_R.choice(frames))
    else:
        pick = lambda: _R.choices([_R.choice(TRAINING), _clause(), _loose()], (0.4, 0.4, 0.2))[0]
        parts = sentence(pick())
        while len(parts) < 60 and _R.random() < 0.4:
            parts += [(_R.choice([" ", " ", " ", "\n"]), ""), *sentence(pick())]
    text, tags = "", []
    for s, kind in parts:
        b = 2 * KINDS.index(kind) + 1 if kind else 0
        tags += [b if k == 0 else b + 1 for k in range(len(s))] if kind else [0] * len(s)
        text += s
    return text, tags


def held_out(n: int, seed: int = 991) -> list[tuple[str, set[tuple[str, str]]]]:
    """(text, details) of frames that training never sees."""
    _R.seed(seed)
    out = []
    for _ in range(n):
        text, tags = sample(KEPT_OUT)
        found, start = set(), None
        for i, t in enumerate([*tags, 0]):
            if start is not None and (t % 2 == 1 or t == 0):
                found.add((KINDS[(tags[start] - 1) // 2], text[start:i].rstrip(". ")))
                start = None
            if t % 2 == 1:
                start = i
        out.append((text, found))
    return out


def _batch(args) -> tuple[float, dict]:
    p, seed, size = args
    _R.seed(seed)
    rows = sorted((sample() for _ in range(3 * size)), key=lambda x: len(x[0]))
    at = _R.randrange(3) * size
    rows = rows[at : at + size]
    n = np.array([len(x[0]) for x in rows])
    codes = np.zeros((len(rows), n.max()), np.int64)
    tags = np.zeros_like(codes)
    for k, (text, y) in enumerate(rows):
        codes[k, : len(text)] = encode(text)
        tags[k, : len(text)] = y
    return fit_batch(p, codes, tags, n, 0.15, np.random.default_rng(seed))


def train(out: str, seconds: float, workers: int = 8, start: str | None = None, hidden: int = 60, emb: int = 24, seed: int = 7, size: int = 40) -> None:
    """Adam on the mean gradient of `workers` batches, with a running mean of the weights."""
    from multiprocessing import get_context

    p = init(hidden, emb, np.random.default_rng(seed))
    if start:  # go on from weights, with smaller steps
        with np.load(start) as z:
            p = {k: z[k].astype(np.float32) for k in z.files}
        seed += 1
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    mean = {k: x.copy() for k, x in p.items()}
    began, step, loss = time.time(), 0, 0.0
    with get_context("fork").Pool(workers) as pool:
        while (done := (time.time() - began) / seconds) < 1:
            got = pool.map(_batch, [(p, seed + 1_000_003 * step + w, size) for w in range(workers)], 1)
            nll = sum(x for x, _ in got) / workers
            g = {k: sum(x[k] for _, x in got) / workers for k in p}
            step += 1
            loss = nll if step == 1 else 0.98 * loss + 0.02 * nll
            norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            rate = (3e-3 if start else 6e-3) * min(1, step / 60) * (1 - done) ** 0.8 + 3e-5
            for k in p:
                d = g[k] * min(1, 1.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.99 * v[k] + 0.01 * d * d
                p[k] = (p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
                mean[k] = (0.99 * mean[k] + 0.01 * p[k]).astype(np.float32)
            if step % 100 == 0:
                print(step, f"{time.time() - began:.0f}s", f"loss {loss:.5f}", flush=True)
                np.savez(out, **mean)
    np.savez(out, **mean)


if __name__ == "__main__":
    assert N_TAGS == 11
    train(sys.argv[1], float(sys.argv[2]) if len(sys.argv) > 2 else 900.0, int(sys.argv[3]) if len(sys.argv) > 3 else 8, sys.argv[4] if len(sys.argv) > 4 else None)
