"""Vocabularies of medication descriptions."""

from __future__ import annotations

# Pharmaceutical forms with their spellings.
FORMS = {
    "TABLETAS": "TABLETA", "TABLETA": "TABLETA", "TAB": "TABLETA", "TAB REC": "TABLETA", "TAB LIB PROL": "TABLETA", "TBS": "TABLETA",
    "TABS": "TABLETA", "COMP": "TABLETA", "COM": "TABLETA", "GRAGEA": "TABLETA", "GRAGEAS": "TABLETA",
    "CAPSULA": "CAPSULA", "CAPSULAS": "CAPSULA", "CAP": "CAPSULA", "CAPS": "CAPSULA", "CAP BLAND": "CAPSULA", "BLANDA": "CAPSULA",
    "CAPSULA BLANDA": "CAPSULA", "CAP DURA": "CAPSULA", "CAPSULA DURA": "CAPSULA", "CP": "CAPSULA",
    "SOLUCION": "SOLUCION", "SOL": "SOLUCION", "LIQ": "SOLUCION", "SLN": "SOLUCION", "GOTAS": "SOLUCION", "GTS": "SOLUCION", "JARABE": "SOLUCION",
    "JBE": "SOLUCION", "JRB": "SOLUCION", "SYR": "SOLUCION", "SUSPENSION": "SOLUCION", "SUSP": "SOLUCION", "SUS": "SOLUCION", "ELIXIR": "SOLUCION",
    "INYECTABLE": "INYECTABLE", "INY": "INYECTABLE", "AMPOLLA": "INYECTABLE", "AMP": "INYECTABLE", "VIAL": "INYECTABLE", "JERINGA": "INYECTABLE",
    "LAPICERO": "INYECTABLE", "PRELLENADA": "INYECTABLE", "CARTUCHO": "INYECTABLE",
    "CREMA": "CREMA", "CRM": "CREMA",
    "UNGUENTO": "UNGUENTO", "UNG": "UNGUENTO", "POMADA": "UNGUENTO", "POM": "UNGUENTO",
    "GEL": "GEL",
    "LOCION": "LOCION",
    "PARCHE": "PARCHE",
    "FRASCO": "UNIDAD", "FCO": "UNIDAD", "SOBRE": "UNIDAD", "SOB": "UNIDAD", "BOLSA": "UNIDAD", "UND": "UNIDAD", "CAJA": "UNIDAD", "KIT": "UNIDAD",
    "UNIDAD": "UNIDAD",
    "POLVO": "POLVO", "GRANULOS": "POLVO",
    "AEROSOL": "AEROSOL", "INHALADOR": "AEROSOL", "SPRAY": "AEROSOL", "PUFF": "AEROSOL",
    "OVULO": "OVULO",
    "SUPOSITORIO": "SUPOSITORIO",
}
UNKNOWN_FORM = "DESCONOCIDA"
#: Spellings from the longest to the shortest; of equal length in the order above.
FORM_ORDER = sorted(FORMS, key=len, reverse=True)

# Words that are no part of a component's name.
IGNORED_WORDS = [
    "DE", "PARA", "CON", "Y", "EN", "LA", "EL", "LOS", "LAS", "DEL", "AL", "MG", "MCG", "G", "ML", "UI", "IU", "GR", "%", "CAJA", "FRASCO",
    "BLISTER", "TUBO", "SOBRE", "X", "POR", "CANTIDAD", "RECUBIERTA", "LIBERACION", "PROLONGADA", "RETARD", "FORTE", "PLUS", "ORAL", "TOPICO",
    "VAGINAL", "NASAL", "OFTALMICO", "RECTAL", "ADULTO", "PEDIATRICO", "INFANTIL", "NEONATAL", "ACIDO", "SODIO", "CALCIO", "POTASIO", "MAGNESIO",
    "ZINC", "HIERRO", "CLORHIDRATO", "BROMURO", "SULFATO", "FUMARATO", "MALEATO", "SUCCINATO", "VALERATO", "PROPIONATO",
]

# Laboratories by keyword, searched in this order.
LAB_KEYWORDS = {
    "GENFAR": "GENFAR", "TECNOQUIMICAS": "TECNOQUIMICAS", "TQ": "TECNOQUIMICAS", "LA SANTE": "LA_SANTE", "LASANTE": "LA_SANTE",
    "LAPROFF": "LAPROFF", "ECAR": "ECAR", "PROCAPS": "PROCAPS", "MK": "MK", "HUMAX": "HUMAX", "BAYER": "BAYER", "ABBOTT": "ABBOTT",
    "SANOFI": "SANOFI", "PFIZER": "PFIZER", "NOVARTIS": "NOVARTIS", "GSK": "GSK", "ASTRAZENECA": "ASTRAZENECA", "JANSSEN": "JANSSEN",
    "MERCK": "MERCK", "MSD": "MERCK", "SIEGFRIED": "SIEGFRIED", "NOVAMED": "NOVAMED", "SYNTHESIS": "SYNTHESIS", "CHALVER": "CHALVER",
    "WINTHROP": "WINTHROP", "GRUNENTHAL": "GRUNENTHAL", "BIOQUIFAR": "BIOQUIFAR", "FARMACAPSULAS": "FARMACAPSULAS",
}
NO_LAB = "NO_IDENTIFICADO"

# Laboratory names that are noise in a description.
LAB_NOISE = [
    "TECNOQUIMICAS", "SIEGFRIED", "FARMACAPSULAS", "SANOFI", "GRUNENTHAL", "PROCAPS", "NOVAMED", "WINTHROP", "ASTRAZENECA", "TECNOFARMA", "COLMED",
    "ECAR", "GENFAR", "PFIZER", "GSK", "NOVARTIS", "ROCHE", "ABBOTT", "BAYER", "MERCK", "BOEHRINGER", "JANSSEN", "MSD", "LILLY", "BRISTOL", "AMGEN",
    "HUMAX", "VITALIS", "BAXTER", "B BRAUN", "BIOSIDUS", "MK", "LA SANTE", "LAFRANCOL", "ANGLOPHARMA", "JGB", "QUIMIDROGAS", "MEMPHIS", "COASPHARMA",
]

# Whole-word form expansions of catalog keys, applied in this order.
CATALOG_FORMS = {
    "TAB": "TABLETA", "TABLETAS": "TABLETA", "COMPRIMIDO": "TABLETA", "CAP": "CAPSULA", "CAPSULAS": "CAPSULA", "SOFTGEL": "CAPSULA",
    "AMP": "AMPOLLA", "VIAL": "AMPOLLA", "INY": "INYECTABLE", "SOL": "SOLUCION", "JAR": "JARABE", "UNT": "UNGUENTO", "CRM": "CREMA",
}
STANDARD_UNITS = ["MG", "ML", "MCG", "TABLETA", "CAPSULA"]
CATALOG_UNITS = ["MG", "ML", "MCG", "G", "UI", "UNIDADES"]
TO_REVIEW = "POR_REVISAR"
NOT_IN_CATALOG = "POR_REVISAR_CATALOGO: "

# Expansions of single words in deep cleaning; an empty one drops the word.
ABBREVIATIONS = {
    "TAB": "TABLETA", "TABS": "TABLETAS", "TB": "TABLETA", "COM": "TABLETA", "COMP": "TABLETA", "CAP": "CAPSULA", "CAPS": "CAPSULAS", "CP": "CAPSULA",
    "JBE": "SOLUCION", "JRB": "SOLUCION", "SYR": "SOLUCION", "JARABE": "SOLUCION", "SUSP": "SUSPENSION", "SUS": "SUSPENSION",
    "SOL": "SOLUCION", "SLN": "SOLUCION", "LIQ": "LIQUIDO", "INY": "INYECTABLE", "INYEC": "INYECTABLE", "VIA": "VIAL",
    "GTS": "SOLUCION", "GOTA": "SOLUCION", "GOTAS": "SOLUCION", "UNG": "UNGUENTO", "POM": "POMADA", "CRM": "CREMA", "CREM": "CREMA",
    "SUP": "SUPOSITORIO", "OV": "OVULO", "INH": "INHALADOR", "AER": "AEROSOL", "PFF": "PUFF", "SOB": "SOBRE",
    "PLV": "SOLUCION", "POL": "SOLUCION", "POLVO": "SOLUCION", "UG": "MCG", "IU": "UI", "GRAG": "GRAGEA",
    "LEUPROLIDE": "LEUPRORELINA", "JERINGA": "INYECTABLE", "PRELLENADA": "", "IMPLANTE": "INYECTABLE", "VIAL": "", "AMPOLLA": "", "AMPO": "", "AMP": "",
    "ESTERIL": "", "RECONSTITUIR": "", "PARA": "", "DE": "", "ADAPALENE": "ADAPALENO", "URSODEOXICOLICO": "URSODESOXICOLICO",
}

# Words that don't identify a product.
STOP_WORDS = [
    "TABLETA", "TABLETAS", "CAPSULA", "CAPSULAS", "SOLUCION", "SUSPENSION", "INYECTABLE", "JARABE", "CREMA", "GEL", "UNGUENTO", "POMADA", "MG",
    "MCG", "G", "ML", "L", "UI", "IU", "POR", "DE", "PARA", "Y", "CON", "CAJA", "FRASCO", "AMPOLLA", "VIAL", "SOBRE", "TUBO", "BLISTER", "ORAL",
    "TOPICO", "VAGINAL", "NASAL", "OFTALMICO", "RECUBIERTA", "LIBERACION", "PROLONGADA", "RETARD", "FORTE", "PLUS", "DIA", "NOCHE", "ADULTO",
    "PEDIATRICO", "INFANTIL", "NEONATAL", "ACIDO", "SODIO", "CALCIO", "CARBONATO", "SULFATO", "CLORURO", "NITRATO", "OXIDO", "POTASIO", "MAGNESIO",
    "HIDROXIDO", "FOSFATO", "ACETATO", "ZINC", "HIERRO", "FUMARATO", "MALEATO", "SUCCINATO", "VALERATO", "PROPIONATO", "DIPROPIONATO",
    "BETAMETASONA", "HIDROCLORURO", "CLORHIDRATO", "BROMURO", "TARTRATO", "CITRATO",
]

# Names of months, and of outcomes with their scores and methods.
MONTHS = [
    "ENERO", "FEBRERO", "MARZO", "ABRIL", "MAYO", "JUNIO", "JULIO", "AGOSTO", "SEPTIEMBRE", "OCTUBRE", "NOVIEMBRE", "DICIEMBRE",
]
NO_MONTH = 99

EXACT, PRESENTATION, SUBSTITUTION, NOT_FOUND = "MATCH EXACTO", "CAMBIO DE PRESENTACIÓN", "SUGERENCIA DE SUSTITUCIÓN", "NO_ENCONTRADO"
SCORES = {EXACT: 100.0, PRESENTATION: 90.0, SUBSTITUTION: 0.0, NOT_FOUND: 0.0}
METHODS = {EXACT: "EXACTO_QUIMICO", PRESENTATION: "PRESENTACION_DIFERENTE", SUBSTITUTION: "SUSTITUCION_TERAPEUTICA", NOT_FOUND: "NONE"}
