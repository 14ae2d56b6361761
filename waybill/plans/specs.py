"""Tables and column lists of both jobs."""

from __future__ import annotations

# Audited tables: columns read, and the report section each belongs to.
AUDIT_TABLES = {
    "przystanki": (["NAZWA", "KOD2", "SYM", "X_KRAJ", "Y_KRAJ"], "stops"),
    "linie": (["STATLINII", "NRF", "NRLINII", "WARLINII", "WAZNAOD", "WAZNADO"], "lines"),
    "trasylinii": (["NRF", "NRLINII", "WARLINII", "WAZNAOD", "NRPRZYST", "KOD2", "NAZPRZYST"], "lines"),
    "kursy": (["STATKURSU", "NRF", "NRKURSU", "WARIANT", "WAZNYOD", "WAZNYDO"], "courses"),
    "trasykursow": (
        ["NRFK", "NRKURSU", "WARIANT", "WAZNYOD", "NRPRZYST", "KOD2", "NAZPRZYST", "DATAOP", "GODZOP"],
        "courses",
    ),
}

# Columns of the three import tables in INSERT order; a star marks date literals.
MACHINE_COLUMNS = """
LOGO NRINW NRFABR NREWUS DATAPROD* TYPBIL DATAPRZ* NRPRF DATAOPRF* NAZRFZPRF LRZPRF DATAZPRF* NAZRZZPRF NRRZZPRF
NRKPPRF NRPRZPRF IMIEZPRF NAZWZPRF STATZPRF NRORF DATAOORF* NAZRFZORF LRZORF NAZRZORF NRRZORF DATAZORF* NRKPORF
NRPRZORF IMIEZORF NAZWZORF STATZORF LRF DATAWBF* LOGOPOWBF DATAKON* DATAFISK* DATAPRZEGL* ADRES KODP MIEJSC NRDECUS
DATADECUS* DATAZAK* LMIESGWAR UWAGI BEZOPSERW WERPSB DATAOP* GODZOP NR_SLUZBOP
"""
EMPLOYEE_COLUMNS = """
NR_SLUZB IMIE NAZWISKO STATUS ODDZIAL DATA_PRZYJ* DATA_ZWOL* TRYBROZWUM ADRES KODP MIEJSC SYM GMINA NAZKR KOD2 KIER
TEL TELKOM ROKROZL PLANDNIURL DNIURLDO DATAURL1* LBDNIROB1 DATAURL2* LBDNIROB2 DATAURL3* LBDNIROB3 NRREJAUT
DATPRZYAUT* NRINWBIL LOGOPB DATPRZYBIL* NRKARPAM DATPRZKP* NAZPRZ NRPRZ DATAREJP* GODZREJP DATAPOCZP* DATAZAKP* NRPRF
LOGOPRF NRPZAD NRPKARDR NRKPPZAD NAZORZ NRORZ DATAREJO* GODZREJO DATAPOCZO* DATAZAKO* NRORF LOGOORF NRZAD NRKARDR
NRKPOZAD NRSPLAC WYSTNOTY WYSTFAKT DRUKDOK ETAT NUMERPRJ DATAWYDPRJ* DATAWAZPRJ* PRAWOJ DWAZLEK DWAZPSYCH DATAPKRT*
DATAKKRT* NUMERKRT WYDKRT DATA_UR* NR_DOWOD NR_PASZ PESEL DATABLEK* DATABPSYCH* NRZASKDPO DATKDPO* NRZASKDPR DATKDPR*
NRTELKOM DTELKOM DATAOP* GODZOP NR_SLUZBOP
"""
CARD_COLUMNS = """
NRKP DATAPROD* POJEMN TYP BILETERKA TYPBIL ODDZ DATAREJ* GODZREJ NRPRACREJ PINKARTY NRSLUZBP DATAZMPIN* NRKIER IMIE
NAZWISKO STATUS STKP1 STKP2 MAXLPAS NRWSIECI KASA LDNIREJ DATAZMST* DATAWST* NROPST DATAZAPST* GODZZAPST BLOKADA
DATAWBLOK* NROPWB DATAZBLOK* NROPZB LZZBAKP NAZWAZBA DATAZZBA* GODZZZBA NROPZZBA NRPZAD LZAD PDZAD ODZAD NRKARDR
DATAZZAD* GODZZZAD NROPZZAD LZZADKP DATAZIN* GODZZIN NROPZIN LZINKP NAZPRZ NRPRZ DATAREJP* GODZREJP DATAPOCZP*
DATAZAKP* NRPRF LOGOPRF NRPZADKK NRPKARDR NRPRACPZ IMIEPRPZ NAZWPRPZ STATPRPZ NAZORZ NRORZ DATAREJO* GODZREJO
DATAPOCZO* DATAZAKO* NRORF LOGOORF NROZAD NROKARDR NRPRACOZ IMIEPROZ NAZWPROZ STATPROZ STKP3 LDNIBLOK STKP4 INFOK1
INFOK2 MINDWOD MAXPRZ DATAWYCOF* DATALIKW* ST205_1 DATAOP* GODZOP NR_SLUZBOP
"""

# Script name -> (source table, target table). The script is saved as import_<name>.sql.
SCRIPTS = {
    "KasyFiskalne": ("kasyfiskalne", "IMP_KasyFiskalne"),
    "Pracownicy": ("pracownicy", "IMP_Pracownicy"),
    "KartyPamieci": ("kartypamieci", "IMP_KartyPamieci"),
}
EMAR_MODEL, EMAR_MIN_VERSION = "EMAR-105", 1.5


def spec_of(columns: str) -> list[tuple[str, str]]:
    """(column, kind) pairs of a column list."""
    return [(c.rstrip("*"), "date" if c.endswith("*") else "value") for c in columns.split()]


MACHINES, EMPLOYEES, CARDS = map(spec_of, (MACHINE_COLUMNS, EMPLOYEE_COLUMNS, CARD_COLUMNS))
