"""Words of placement pages by language, names of departments, and labels. All of it are fixed values."""

from __future__ import annotations

LANGUAGES = ("de", "fr", "it", "en")
# A word that stands twice, with and without accent, counts twice.
ROLES = {
    "de": ("unterassistenz", "unterassistent", "unterassistentin", "wahlstudienjahr", "praktisches jahr", "pj", "famulatur", "medizinstudierende"),
    "fr": ("stage", "stagiaire", "sous-assistant", "sous-assistante", "etudiant en medecine", "etudiant en medecine"),
    "it": ("tirocinio", "stage", "studente di medicina", "studenti di medicina"),
    "en": ("clinical placement", "medical student", "elective", "internship"),
}
APPLICATIONS = {
    "de": ("bewerbung", "bewerbungen", "bewerben", "kontakt", "online-formular"),
    "fr": ("candidature", "postulation", "contact", "formulaire"),
    "it": ("candidatura", "contatto", "formulario"),
    "en": ("application", "apply", "contact", "form"),
}
AVAILABLE = {
    "de": ("ab sofort", "freie platze", "freie platze", "verfugbar", "verfugbar"),
    "fr": ("des maintenant", "des maintenant", "disponible", "places disponibles"),
    "it": ("da subito", "disponibile", "posti disponibili", "posto disponibile"),
    "en": ("available", "available from", "immediately"),
}
UNAVAILABLE = {
    "de": ("ausgebucht", "keine freien platze", "keine freien platze"),
    "fr": ("complet", "aucune place disponible"),
    "it": ("occupato", "nessun posto disponibile", "posti esauriti"),
    "en": ("fully booked", "no places available"),
}
DEPARTMENTS = {
    "internal-medicine": {"de": ("Innere Medizin",), "fr": ("Médecine interne", "Medecine interne"), "it": ("Medicina interna",), "en": ("Internal medicine",)},
    "surgery": {"de": ("Chirurgie",), "fr": ("Chirurgie",), "it": ("Chirurgia",), "en": ("Surgery",)},
    "pediatrics": {"de": ("Pädiatrie", "Padiatrie", "Kinderklinik"), "fr": ("Pédiatrie", "Pediatrie"), "it": ("Pediatria",), "en": ("Pediatrics", "Paediatrics")},
    "gynecology": {"de": ("Gynäkologie", "Gynaekologie", "Frauenheilkunde"), "fr": ("Gynécologie", "Gynecologie"), "it": ("Ginecologia",), "en": ("Gynecology", "Gynaecology")},
    "psychiatry": {"de": ("Psychiatrie",), "fr": ("Psychiatrie",), "it": ("Psichiatria",), "en": ("Psychiatry",)},
    "anesthesiology": {"de": ("Anästhesie", "Anästhesiologie", "Anaesthesie"), "fr": ("Anesthésiologie", "Anesthesiologie", "Anesthésie"), "it": ("Anestesia", "Anestesiologia"), "en": ("Anesthesia", "Anaesthesia", "Anesthesiology")},
    "emergency-medicine": {"de": ("Notfallmedizin", "Notfallstation"), "fr": ("Urgences", "Médecine d'urgence"), "it": ("Pronto soccorso", "Medicina d'urgenza"), "en": ("Emergency medicine", "Emergency department")},
    "radiology": {"de": ("Radiologie",), "fr": ("Radiologie",), "it": ("Radiologia",), "en": ("Radiology",)},
    "neuroradiology": {"de": ("Neuroradiologie",), "fr": ("Neuroradiologie", "Neuroradiologie"), "it": ("Neuroradiologia",), "en": ("Neuroradiology",)},
    "ophthalmology": {"de": ("Augenheilkunde", "Augenklinik"), "fr": ("Ophtalmologie",), "it": ("Oftalmologia",), "en": ("Ophthalmology",)},
    "orthopedics": {"de": ("Orthopädie", "Orthopadie", "Traumatologie"), "fr": ("Orthopédie", "Orthopedie", "Traumatologie"), "it": ("Ortopedia", "Traumatologia"), "en": ("Orthopedics", "Orthopaedics", "Trauma")},
}
# Department keys as they are met in records, by their canonical value.
DEPARTMENT_KEYS = {
    "anesthesiology": ("anesthesie", "anaesthesie", "anesthesiologie", "anasthesiologie", "anaesthesiologie", "anesthesiology", "anesthesia"),
    "ophthalmology": ("augenheilkunde", "augenklinik", "ophthalmology"),
    "surgery": ("chirurgie", "chirurgia", "surgery"),
    "emergency-medicine": ("emergency-medicine", "notfallmedizin", "notfallstation", "pronto-soccorso", "urgences"),
    "gynecology": ("frauenheilkunde", "gynecology", "gynakologie", "gynaekologie", "gynecologie", "ginecologia"),
    "internal-medicine": ("innere-medizin", "internal-medicine", "medecine-interne", "medicina-interna"),
    "neuroradiology": ("neuroradiologie", "neuroradiology"),
    "orthopedics": ("orthopadie", "orthopaedie", "orthopedics", "traumatologie"),
    "pediatrics": ("padiatrie", "paediatrie", "pediatrics", "pediatria", "pediatrie"),
    "psychiatry": ("psychiatrie", "psychiatry", "psichiatria"),
    "radiology": ("radiologie", "radiologia", "radiology"),
}
DEPARTMENT_LABELS = {
    "anesthesiology": "Anesthesiology", "ophthalmology": "Ophthalmology", "surgery": "Surgery", "emergency-medicine": "Emergency medicine", "gynecology": "Gynecology",
    "internal-medicine": "Internal medicine", "neuroradiology": "Neuroradiology", "orthopedics": "Orthopedics", "pediatrics": "Pediatrics", "psychiatry": "Psychiatry", "radiology": "Radiology",
}
LABELS = {
    "application-only": "Application only", "auto-published": "Auto published", "available-from": "Available from", "clinical-elective": "Clinical elective",
    "fully-booked-until": "Fully booked until", "generic-parser": "Generic parser", "hospital-confirmed": "Hospital confirmed", "needs-human-review": "Needs human review",
    "not-specified": "Not specified", "site-parser": "Site parser",
}
# Names of institutions after normalisation, by their common key.
INSTITUTIONS = {
    "usz": ("universitatsspital zurich", "universitaetsspital zuerich", "universitat hospital zurich", "university hospital zurich", "usz"),
    "usb": ("universitatsspital basel", "university hospital basel", "usb basel"),
    "inselgruppe": ("inselspital bern", "university hospital bern", "insel gruppe"),
    "hug": ("hopitaux universitaires de geneve", "geneva university hospitals", "hug"),
    "chuv": ("centre hospitalier universitaire vaudois", "lausanne university hospital", "chuv"),
    "eoc": ("ente ospedaliero cantonale", "eoc"),
}
# Tokens of institution names that tell none from another.
COMMON_TOKENS = ("and", "bei", "cantonale", "cantonaux", "de", "der", "des", "du", "hospital", "kantonsspital", "la", "le", "les", "of", "the", "und", "universitat")
CANTONS = ("AG", "AI", "AR", "BE", "BL", "BS", "FR", "GE", "GL", "GR", "JU", "LU", "NE", "NW", "OW", "SG", "SH", "SO", "SZ", "TG", "TI", "UR", "VD", "VS", "ZG", "ZH")
