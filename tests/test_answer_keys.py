"""The answer-key resolver on files that mix forms, file by file and together."""

import pytest

from corpusmill.operators import answer_keys as K

EXAM = "exam string, booklet string, file string, cover string"
SOURCE = "exam string, source string, ord int, file string, text string, solution boolean, flow string"


def resolved(spark, exams, sources):
    got = K.resolved_keys(spark.createDataFrame(exams, EXAM), spark.createDataFrame(sources, SOURCE)).collect()
    return {(r.exam, r.number, r.language): (r.answer, r.source, r.reading) for r in got}


FORMS = {
    "paired lines": ("Questão 1 2 3\n\nGabarito A * anulada", False, {(1, None): "A", (3, None): "anulada"}),
    "paired lines, bare": ("1 2 3 4 5\nA B C D E", False, {(k, None): "ABCDE"[k - 1] for k in range(1, 6)}),
    "four bare numbers are no table": ("1 2 3 4\nA B C D", False, {}),
    "numbered": ("Questão 012 – Resposta correta: C\n 13. gabarito: D\n14 Alternativa correta: e\n38. Resposta a 45 C", False, {(12, None): "C", (13, None): "D", (45, None): "C"}),
    "block": ("Questão 1\nTexto A.\nResposta B\nQuestão 2\nGabarito: D Resposta C\nquestao 3\n3. Resposta certa A alternativa correta é a E\n4. Gabarito B", True, {(1, None): "B", (2, None): "D", (3, None): "E"}),
    "block, last of all": ("Questão 7\nAlternativa D\nAlternativa A: incorreta\nQuestão 8\nAlternativa B é a correta", True, {(7, None): "D", (8, None): "B"}),
    "marked": ("QUESTÃO 4 Texto\nA) errada\nC) CORRETA\nQUESTAO 05\nB) CORRETA e D) CORRETA\nQUESTÃO 1234\nA) CORRETA", False, {(4, None): "C", (5, None): "B"}),
    "loose": ("1 A   2 B C   3 Anulada\n4 A B C  5\nPágina 6, 7 E\nx9 D", False, {(1, None): "A", (2, "inglês"): "B", (2, "espanhol"): "C", (3, None): "Anulada", (7, None): "E"}),
    "loose, of a solution": ("1 A   2 B", True, {}),
    "nothing": (None, False, {}),
    "empty": ("", True, {}),
}


@pytest.fixture(scope="module")
def all_forms(spark):
    exams = [(name, None, None, None) for name in FORMS]
    return resolved(spark, exams, [(name, "s", 1, "f.pdf", text, solution, None) for name, (text, solution, _) in FORMS.items()])


@pytest.mark.parametrize("name", FORMS)
def test_form(all_forms, name):
    assert {k[1:]: v[0] for k, v in all_forms.items() if k[0] == name} == FORMS[name][2]


def test_order_vetoes_and_columns(spark):
    exams = [("a", "Amarelo 2", "prova.pdf", None), ("b", None, "prova azul.pdf", "CADERNO 5"), ("c", None, None, "Prova\nCaderno 3 - Rosa"), ("d", None, None, None)]
    columns = "Azul Gab_Azul Amarelo Gab_Amarelo\n1 A 1 B\n2 C 2 Anulada\n3 D\n"
    sources = [
        ("a", "commented", 1, "Gabarito comentado.pdf", "1 E\n9 E", False, None),
        ("a", "solution", 2, "Resolução.pdf", "4. Gabarito: E\n9. Gabarito: D", True, None),
        ("a", "plain", 3, "Gabarito sem comentários.pdf", "9 A", True, None),
        ("a", "columns", 4, "Gabarito.pdf", columns, False, None),
        ("a", "blue", 0, "Gabarito AZUL.pdf", "1 C 2 C 3 C 4 C", False, None),
        ("b", "header", 1, "g.pdf", "CADERNO 8 - Azul\n1 A", False, None),
        ("b", "right", 2, "g.pdf", "Caderno 5\n1 B", False, None),
        ("b", "two numbers", 3, "g.pdf", "Caderno 5\nCaderno 8\n2 B", False, None),
        ("c", "pink", 1, "Gabarito rosa.pdf", "1 A", False, None),
        ("c", "white", 2, "g.pdf", "CADERNO 3 BRANCO\n2 A", False, None),
        ("d", "any", 1, "Gabarito rosa.pdf", "1 D", False, None),
        (None, "nobody", 1, None, "1 D", None, None),
    ]
    got = resolved(spark, exams, sources)
    assert {k: v[:2] for k, v in got.items()} == {
        ("a", 1, None): ("B", "columns"), ("a", 2, None): ("Anulada", "columns"), ("a", 4, None): ("E", "solution"), ("a", 9, None): ("A", "plain"),
        ("b", 1, None): ("B", "right"), ("b", 2, None): ("B", "two numbers"), ("c", 1, None): ("A", "pink"), ("d", 1, None): ("D", "any"), (None, 1, None): ("D", "nobody"),
    }
    vetoes = {r.source: r.veto for r in K.read_sources(spark.createDataFrame(exams, EXAM), spark.createDataFrame(sources, SOURCE)).collect() if r.veto}
    assert vetoes == {"blue": "other colour", "header": "other booklet", "white": "other colour"}


def test_one_file_in_several_forms(spark):
    text = "Questão 1 2\nGabarito A B\n2. Gabarito: C\n3. Gabarito: D\nQUESTÃO 3\nE) CORRETA\nQUESTÃO 4\nB) CORRETA\n3 A 5 C\n5 D"
    got = resolved(spark, [("x", None, None, None)], [("x", "s", 1, "f", text, False, None)])
    assert {k[1]: (v[0], v[2]) for k, v in got.items()} == {1: ("A", "paired lines"), 2: ("B", "paired lines"), 3: ("D", "numbered"), 4: ("B", "marked"), 5: ("C", "loose")}


def test_many_numbered_answers_leave_blocks_unread(spark):
    numbered = "\n".join(f"{k}. Gabarito: A" for k in range(1, 11))
    text = numbered + "\nQuestão 20\nTexto.\nResposta B"
    got = resolved(spark, [("x", None, None, None)], [("x", "s", 1, "f", text, True, None), ("x", "t", 2, "f", "Questão 21\nnada", True, "Questão 21\nResposta C")])
    assert (("x", 20, None) not in got) and got[("x", 21, None)][0] == "C"
