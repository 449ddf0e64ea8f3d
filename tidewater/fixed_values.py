"""Literals that must equal the reference's for equal results.

They are data, not logic; every module takes them from here.
"""

# Note status labels (V10 ``status``), in the order the status is decided.
STATUS_CANCELLED = "Cancelada"
STATUS_AUTHORISED = "Autorizada"
STATUS_PENDING = "Pendente SEFAZ"

# Tax-authority status code of an authorised note (``cStat``).
AUTHORISED_CODE = "100"

# Marker written by the soft delete (K5).
DELETED_MARKER = "EXCLUIDO"

# Work-interval actions (V4 / V5): an interval starts with one of the first
# pair and ends with one of the second.
START_ACTIONS = ("STARTED", "RESUMED")
END_ACTIONS = ("PAUSED", "COMPLETED")

# ``included`` element types read by the maintenance views.
LOCATION_TYPES = ("location", "location-folder")

# Line-item order type of internal consumption (Q24, Q30, export).
INTERNAL_CONSUMPTION = "Consumo Interno"

# Tax-note key: prefix of ``infNFe/@Id`` and key length.
NOTE_KEY_PREFIX = "NFe"
NOTE_KEY_LENGTH = 44

# Constant fields of every stock-movement export document (K7), and the unit.
EXPORT_REQUEST_CONSTANTS = {
    "TipoDeProcessamento": "ProcVendaParaBaixaEstoque",
    "ExecucaoImediata": False,
    "NomeParaArmazenamentoDoConteudo": "AlmoxVendaParaBaixaEstoque",
    "ConteudoCompactado": False,
    "MensagemDoSolicitante": "IncluirProcVendaParaBaixaEstoque",
}
EXPORT_UNIT = "UN"
