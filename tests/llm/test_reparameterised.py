"""Recall and precision of template decontamination on questions with other numbers, names and units."""

import random

from cloudloom.llm import decontaminate

#: Word problems in four languages; A and B are names, N, M and K numbers, U a unit. A, N or U stands twice in each.
QUESTIONS = """
{A} buys {N} red apples and {M} green pears at the market and then {A} gives {K} of them to {B} before lunch .
A train leaves the station at {N} {U} per hour and another follows {M} minutes later at {K} {U} per hour until both meet .
If {A} reads {N} pages on each day and {B} reads {M} pages , how long until {A} has read {K} pages in all ?
A tank holds {N} {U} of water and loses {M} {U} every night , so how much is left when {A} looks after {K} nights ?
The shop of {A} sold {N} books in spring and {M} books in summer , what share of all books did {A} sell in summer ?
Every morning {A} walks {N} {U} to the school and in the evening {A} runs {M} {U} back along the river with {B} .
Der Bauer {A} verkauft {N} Äpfel an {B} und danach {M} Birnen an {B} auf dem Markt in der Stadt .
Ein Zug fährt mit {N} {U} in der Stunde ab und ein zweiter folgt nach {M} Minuten mit {K} {U} in der Stunde .
Wenn {A} an jedem Tag {N} Seiten liest und {B} nur {M} Seiten , wie lange braucht {A} dann für das ganze Buch ?
Das Becken fasst {N} {U} Wasser und verliert jede Nacht {M} {U} , wie viel ist nach {K} Nächten noch darin ?
Die Klasse von {A} hat {N} Kinder und die Klasse von {B} hat {M} Kinder , wie viele fehlen der Klasse von {A} noch ?
Am Montag läuft {A} genau {N} {U} durch den Wald und am Freitag läuft {A} noch {M} {U} am Fluss entlang .
Le matin {A} achète {N} pommes rouges et {M} poires vertes au marché , puis {A} en donne {K} à {B} avant midi .
Un train part de la gare à {N} {U} par heure et un autre le suit {M} minutes plus tard à {K} {U} par heure .
Si {A} lit {N} pages chaque jour et que {B} lit {M} pages , combien de jours faut-il à {A} pour finir le livre ?
Le réservoir contient {N} {U} et perd {M} {U} chaque nuit , combien reste-t-il après {K} nuits sans aucune pluie ?
La classe de {A} compte {N} élèves et la classe de {B} compte {M} élèves , combien en manque-t-il à la classe de {A} ?
Chaque soir {A} marche {N} {U} vers la maison puis {A} court {M} {U} le long de la rivière avec son chien .
Por la mañana {A} compra {N} manzanas rojas y {M} peras verdes en el mercado y luego {A} da {K} a {B} .
Un tren sale de la estación a {N} {U} por hora y otro lo sigue {M} minutos después a {K} {U} por hora .
Si {A} lee {N} páginas cada día y {B} lee {M} páginas , cuántos días necesita {A} para leer todo el libro ?
El tanque contiene {N} {U} y pierde {M} {U} cada noche , cuánto queda en él después de {K} noches sin lluvia ?
La clase de {A} tiene {N} alumnos y la clase de {B} tiene {M} alumnos , cuántos le faltan a la clase de {A} ?
Cada tarde {A} camina {N} {U} hasta la casa y después {A} corre {M} {U} junto al río con su perro .
""".strip().splitlines()
NAMES = "Anna Bruno Carla David Elena Felix Greta Hugo Irina Jonas Karin Luis Maria Nils Olga Pablo Rosa Simon Tanja Victor".split()
UNITS = ("km", "m", "kg", "l", "ml", "cm", "g", "t")


def fill(question, rng, twice=True):
    """The question with drawn values; without ``twice`` each place of a repeated value is drawn anew."""
    names = rng.sample(NAMES, 4)
    numbers = rng.sample(range(11, 999), 3)
    units = rng.sample(UNITS, 2)
    text = question
    for slot, values in (("A", (names[0], names[2])), ("B", (names[1], names[3])), ("U", units)):
        text = text.replace("{" + slot + "}", values[0], 1).replace("{" + slot + "}", values[0 if twice else 1])
    for slot, value in zip("NMK", numbers):
        text = text.replace("{" + slot + "}", str(value))
    return text.replace(" .", ".").replace(" ,", ",").replace(" ?", "?")


def prose(rng, n=60):
    return " ".join("".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_questions_with_other_values_are_found(spark, docs_of):
    rng = random.Random(9)
    items = [(k, fill(q, rng)) for k, q in enumerate(QUESTIONS)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    around = lambda text: f"{prose(rng)}. {text} {prose(rng)}"
    verbatim = [(k, around(text)) for k, text in items]
    changed = [(1_000 + 100 * k + j, around(fill(q, rng))) for k, q in enumerate(QUESTIONS) for j in range(10)]
    broken = [(10_000 + 100 * k + j, around(fill(q, rng, twice=False))) for k, q in enumerate(QUESTIONS) for j in range(3)]
    clean = [(20_000 + k, prose(rng, 200)) for k in range(100)]
    found = {r.doc_id: r["items"] for r in decontaminate.contaminated(docs_of(verbatim + changed + broken + clean), bench).collect()}
    assert all(found.get(k) == str(k) for k, _ in verbatim)
    hits = sum(found.get(k) == str((k - 1_000) // 100) for k, _ in changed)
    wrong = sum(k in found for k, _ in broken)
    print(f"re-parameterised: {hits} of {len(changed)}; inconsistent: {wrong} of {len(broken)}; clean: {sum(k in found for k, _ in clean)}")
    missed = sorted({(k - 1_000) // 100 for k, _ in changed if k not in found}), sorted({(k - 10_000) // 100 for k, _ in broken if k in found})
    assert hits >= 0.9 * len(changed) and wrong <= 0.1 * len(broken), missed
    assert not any(k in found for k, _ in clean)


def test_copies_in_other_letters_and_with_longer_names(spark, docs_of):
    rng = random.Random(4)
    items = [(k, fill(q, rng)) for k, q in enumerate(QUESTIONS)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    around = lambda text: f"{prose(rng)}. {text} {prose(rng)}"
    longer = lambda text: " ".join(f"{w} Lopez" if w in NAMES else w for w in text.split(" "))
    forms = {"lower": str.lower, "upper": lambda t: t.upper().replace("SS", "ß") if "ß" in t else t.upper(), "title": str.title, "names": longer}
    docs = [(1_000 * j + k, around(f(text))) for j, f in enumerate(forms.values()) for k, text in items]
    found = {r.doc_id: r["items"] for r in decontaminate.contaminated(docs_of(docs), bench).collect()}
    for j, name in enumerate(forms):
        hits = sum(found.get(1_000 * j + k) == str(k) for k, _ in items)
        print(f"{name}: {hits} of {len(items)}")
        assert hits >= 0.95 * len(items), name


def test_tables_of_numbers(spark, docs_of):
    rng = random.Random(6)
    numbers = lambda n: " ".join(str(rng.randrange(10_000)) for _ in range(n))
    bench = spark.createDataFrame([(1, numbers(30)), (2, f"the sum of {numbers(12)} is what")], "item_id long, text string")
    text = {r.item_id: r.text for r in bench.collect()}
    docs = [(1, f"see {text[1]} here"), (2, f"see {text[2]} here"), *((k, numbers(400)) for k in range(10, 20))]
    found = {r.doc_id: r["items"] for r in decontaminate.contaminated(docs_of(docs), bench).collect()}
    assert found == {1: "1", 2: "2"}
