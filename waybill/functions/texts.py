"""Wording of findings and reports."""

from __future__ import annotations

# The wording users of the reports know. Braces stand for columns, in order.
SAME_NAME = "Przystanki {} mają taką samą nazwę."
SAME_NAME_AND_CODE = "Przystanki {} mają taką samą nazwę i kod."
SAME_CODE = "Przystanki {} mają taki sam kod."
NO_ADMINISTRATION = "Przystanek [{}] [{}] nie ma przypisanej administracji."
NO_COORDINATES = "Przystanek [{}] [{}] nie ma przypisanych współrzędnych."
LINE_REPEAT = "[{}] Linia {} ({}), wariant {}, ważna od {}, przystanek [ {} ], kod2: [ {} ] następuje jeden po drugim."
COURSE_REPEAT = "[{}] Kurs {} ({}), wariant {}, ważny od {}, przystanek [ {} ], kod2: [ {} ] następuje jeden po drugim."
NO_VERSION = "Bileterka {} {} nie ma wersji oprogramowania!"
OLD_VERSION = "Bileterka {} {} ma wersję oprogramowania {}!"
SECTION_HEADS = {"stops": "Przystanki: {}", "lines": "Linie: {}", "courses": "Kursy: {}"}
ERRORS_FOUND = "Znaleziono błędów: {}"
NO_ERRORS = "Nie znaleziono błędów."
PARAMETERS_HEAD = "Parametry weryfikacji:"
COMPANY = "Firma: {}"
CHECK_COORDINATES = "Sprawdź współrzędne przystanków: {}"
CHECK_ADMINISTRATION = "Sprawdź administrację przystanków: {}"
CHECK_FOREIGN = "Sprawdź linie/kursy firm obcych: {}"
STATUS_AND_DATE = "Linie/kursy: {}, data ważności do > {} lub pole puste"
YES, NO = "tak", "nie"
ONLY_ACTIVE, ALL_STATUSES = "tylko aktywne", "wszystkie"

# Our own wording, for cases in which a whole run used to end.
NOT_CHECKED = "Nie sprawdzono żadnych danych."
NO_TABLE = "Archiwum nie zawiera tabeli {}."


def sql_string(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\t", "\\t")
    return f"'{escaped}'"


def worded(text: str, *values: str) -> str:
    """SQL text that fills the braces of a wording with SQL expressions; missing values become empty text."""
    pieces = text.split("{}")
    parts = [sql_string(pieces[0])]
    for value, piece in zip(values, pieces[1:]):
        parts += [f"coalesce(cast({value} as string), '')", sql_string(piece)]
    return f"concat({', '.join(parts)})"
