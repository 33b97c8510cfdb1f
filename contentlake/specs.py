"""What the two datasets look like. Everything here is a fixed value: header names,
column lists, hash inputs and renames that results depend on."""

from __future__ import annotations

from dataclasses import dataclass, field

TAGS = ("creds", "sheet_name")
# Position of a row in its batch: sheet order in the registry, row number in the sheet.
ORDINAL = ("sheet_ord", "row_idx")
ERROR_REASON = "error_reason"
LINEAGE = ("snapshot_ts", "snapshot_date", "run_id", "row_hash_raw")


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    header_row: int
    id_column: str  # snake_case; rows where it is '' are dropped
    date_columns: tuple[str, ...]  # snake_case; the first is the primary date
    numeric_columns: tuple[str, ...] = ()  # raw header names
    percent_columns: tuple[str, ...] = ()  # raw header names
    count_columns: tuple[str, ...] = ()  # snake_case; rounded to bigint in bronze
    drop_columns: tuple[str, ...] = ()  # snake_case
    hash_columns: tuple[str, ...] = ()  # snake_case inputs of row_hash_raw
    empty_text_is_null: bool = False
    text_columns: tuple[str, ...] = field(default=())  # other columns silver reads


VIDEO = DatasetSpec(
    name="video",
    header_row=2,
    id_column="tanggal",
    date_columns=("tanggal", "waktu"),
    numeric_columns=(
        "VV",
        "Likes",
        "Komentar",
        "Dibagikan",
        "Pengikut baru",
        "Klik Video ke LIVE",
        "Produk Dilihat",
        "Klik Produk",
        "Pembeli",
        "Pesanan Video",
        "Produk yang terjual dari video",
        "Nilai barang dagangan bruto (Video) (Rp)",
        "GPM (Rp)",
        "GMV yang didapat dari video jualan (Rp)",
    ),
    percent_columns=(
        "Rasio klik tayang video",
        "Rasio video ke LIVE",
        "Persentase video yang ditonton hingga selesai",
        "Rasio pesanan per klik video",
    ),
    count_columns=(
        "vv",
        "likes",
        "komentar",
        "dibagikan",
        "pengikut_baru",
        "klik_video_ke_live",
        "produk_dilihat",
        "klik_produk",
        "pembeli",
        "pesanan_video",
        "produk_yang_terjual_dari_video",
    ),
    drop_columns=(
        "pesanan_sku_dari_video",
        "pesanan_sku_tidak_langsung_dari_video",
        "produk_yang_terjual_dari_video_kolom_baru",
        "produk_yang_terjual_dari_video_secara_tidak_langsung",
        "gmv_video_rp",
        "gmv_tidak_langsung_dari_video_rp",
        "diagnosis",
    ),
    hash_columns=(
        "tanggal",
        "toko",
        "nama_kreator",
        "id_video",
        "vv",
        "gmv_yang_didapat_dari_video_jualan_rp",
    ),
    empty_text_is_null=True,
    text_columns=(
        "toko",
        "nama_kreator",
        "id_kreator",
        "informasi_video",
        "id_video",
        "produk",
    ),
)

PRODUCTION = DatasetSpec(
    name="produksi",
    header_row=0,
    id_column="id_konten",
    date_columns=("tanggal", "tanggal_jadi"),
    drop_columns=(
        "kode",
        "no_video",
        "no_cep",
        "funnel",
        "struktur",
        "cvp",
        "platform",
        "caption",
        "link_drive",
        "bulan",
    ),
    hash_columns=("tanggal", "scripter", "id_konten"),
    text_columns=(
        "scripter",
        "editor",
        "akun",
        "produk",
        "jenis_konten",
        "tipe_konten",
        "talent_visual",
        "kategori_konten",
        "isu",
        "layout",
        "script",
        "brief_editing",
        "cta",
        "talent_vo",
        "referensi_musik",
        "sound",
        "visual_hook",
        "audio_hook",
        "progress_edit",
        "progres_upload",
        "link_konten",
        "id_konten",
        "hook",
        "tingkat_konten",
    ),
)

# Bronze name -> silver name, for the video columns that change type and name.
SILVER_VIDEO_COUNTS = {
    "vv": "vv",
    "likes": "likes",
    "komentar": "komentar",
    "dibagikan": "dibagikan",
    "pengikut_baru": "pengikut_baru",
    "klik_video_ke_live": "klik_video_ke_live",
    "produk_dilihat": "produk_dilihat",
    "klik_produk": "klik_produk",
    "pembeli": "pembeli",
    "pesanan_video": "pesanan_video",
    "produk_yang_terjual_dari_video": "produk_terjual_video",
}
SILVER_VIDEO_MONEY = {
    "nilai_barang_dagangan_bruto_video_rp": "gmv_bruto_video",
    "gpm_rp": "gpm",
    "gmv_yang_didapat_dari_video_jualan_rp": "gmv_didapat_video",
}
SILVER_VIDEO_RATIOS = {
    "rasio_klik_tayang_video": "ctr_video",
    "rasio_video_ke_live": "ratio_video_ke_live",
    "persentase_video_yang_ditonton_hingga_selesai": "pct_tonton_selesai",
    "rasio_pesanan_per_klik_video": "cvr_video",
}

SILVER_VIDEO_KEYS = ("tanggal", "toko", "id_kreator", "id_video")
SILVER_VIDEO_COLUMNS = (
    "tanggal",
    "toko",
    "nama_kreator",
    "id_kreator",
    "informasi_video",
    "id_video",
    "waktu",
    "produk",
    *SILVER_VIDEO_COUNTS.values(),
    *SILVER_VIDEO_MONEY.values(),
    *SILVER_VIDEO_RATIOS.values(),
)

SILVER_PRODUCTION_KEYS = ("tanggal", "akun", "id_konten")
SILVER_PRODUCTION_COLUMNS = (
    "tanggal",
    "scripter",
    "editor",
    "akun",
    "produk",
    "jenis_konten",
    "tipe_konten",
    "talent_visual",
    "kategori_konten",
    "isu",
    "layout",
    "script",
    "brief_editing",
    "cta",
    "talent_vo",
    "referensi_musik",
    "sound",
    "visual_hook",
    "audio_hook",
    "progress_edit",
    "tanggal_jadi",
    "progres_upload",
    "link_konten",
    "id_konten",
    "hook",
    "tingkat_konten",
)

# Inputs of the production clean hash, in hash order.
PRODUCTION_HASH_COLUMNS = (
    "tanggal",
    "akun",
    "id_konten",
    "scripter",
    "editor",
    "produk",
    "jenis_konten",
    "tipe_konten",
    "talent_visual",
    "kategori_konten",
    "isu",
    "layout",
    "script",
    "brief_editing",
    "cta",
    "talent_vo",
    "referensi_musik",
    "sound",
    "visual_hook",
    "audio_hook",
    "progress_edit",
    "hook",
    "tingkat_konten",
    "tanggal_jadi",
    "progres_upload",
    "link_konten",
)

# Gold fact: (output name, silver name), fact side then dimension side.
GOLD_FACT = (
    ("id_video", "id_video"),
    ("tanggal", "tanggal"),
    ("toko", "toko"),
    ("nama_kreator", "nama_kreator"),
    ("informasi_video", "informasi_video"),
    ("waktu", "waktu"),
    ("produk_sku", "produk"),
    ("views", "vv"),
    ("klik_video_ke_live", "klik_video_ke_live"),
    ("produk_dilihat", "produk_dilihat"),
    ("klik_produk", "klik_produk"),
    ("pembeli", "pembeli"),
    ("pesanan_video", "pesanan_video"),
    ("produk_terjual_video", "produk_terjual_video"),
    ("gmv_bruto_video", "gmv_bruto_video"),
    ("gmv_didapat_video", "gmv_didapat_video"),
)
GOLD_DIMENSION = (
    ("tanggal_produksi", "tanggal"),
    ("scripter", "scripter"),
    ("produk", "produk"),
    ("editor", "editor"),
    ("jenis_konten", "jenis_konten"),
    ("tipe_konten", "tipe_konten"),
    ("talent_visual", "talent_visual"),
    ("kategori_konten", "kategori_konten"),
    ("isu", "isu"),
    ("layout", "layout"),
    ("script", "script"),
    ("cta", "cta"),
    ("talent_vo", "talent_vo"),
    ("referensi_musik", "referensi_musik"),
    ("sound", "sound"),
    ("visual_hook", "visual_hook"),
    ("audio_hook", "audio_hook"),
    ("link_konten", "link_konten"),
    ("hook", "hook"),
)
