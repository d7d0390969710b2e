"""Column vocabulary of the reports. Everything here is a fixed value: names must match those users know."""

from __future__ import annotations

# Working name of a column and its display name.
COLUMN_NAMES = {
    "Ekipman_ID": "Ekipman_ID",
    "Equipment_Class_Primary": "Ekipman_Sınıfı",
    "Equipment_Type": "Ekipman_Tipi",
    "component_voltage": "Gerilim_Seviyesi",
    "Voltage_Class": "Gerilim_Sınıfı",
    "Is_MV": "OG_Bayrağı",
    "Is_LV": "AG_Bayrağı",
    "Is_HV": "YG_Bayrağı",
    "Ekipman_Yaşı_Yıl": "Ekipman_Yaşı_Yıl",
    "Yas_Beklenen_Omur_Orani": "Yaş_Ömür_Oranı",
    "Beklenen_Ömür_Yıl": "Beklenen_Ömür_Yıl",
    "Age_Risk_Category": "Yaş_Risk_Kategorisi",
    "Toplam_Arıza_Sayisi_Lifetime": "Toplam_Arıza_Sayısı",
    "Arıza_Sayısı_3ay": "Arıza_Sayısı_3Ay",
    "Arıza_Sayısı_6ay": "Arıza_Sayısı_6Ay",
    "Arıza_Sayısı_12ay": "Arıza_Sayısı_12Ay",
    "Son_Arıza_Gun_Sayisi": "Son_Arıza_Gün_Sayısı",
    "Son_Arıza_Tarihi": "Son_Arıza_Tarihi",
    "Ilk_Ariza_Tarihi": "İlk_Arıza_Tarihi",
    "Ilk_Arizaya_Kadar_Yil": "İlk_Arızaya_Kadar_Yıl",
    "Time_To_Repair_Hours_mean": "Onarım_Süresi_Ort_Saat",
    "Time_To_Repair_Hours_max": "Onarım_Süresi_Maks_Saat",
    "Time_To_Repair_Hours_min": "Onarım_Süresi_Min_Saat",
    "Time_To_Repair_Hours_std": "Onarım_Süresi_Std_Saat",
    "MTBF_Gün": "OAZS_Gün",
    "MTBF_InterFault_Gün": "OAZS_ArızaArası_Gün",
    "MTBF_Lifetime_Gün": "OAZS_Ömür_Gün",
    "MTBF_Observable_Gün": "OAZS_Gözlem_Gün",
    "MTBF_Degradation_Ratio": "OAZS_Bozulma_Oranı",
    "MTBF_InterFault_Trend": "Arıza_Sıklık_Trendi",
    "MTBF_InterFault_StdDev": "OAZS_Değişkenlik_Oranı",
    "Baseline_Hazard_Rate": "Temel_Tehlike_Oranı",
    "Reliability_Score": "Güvenilirlik_Skoru",
    "Arıza_Nedeni_Çeşitlilik": "Arıza_Nedeni_Çeşitlilik",
    "Arıza_Nedeni_Tutarlılık": "Arıza_Nedeni_Tutarlılık",
    "Arıza_Nedeni_İlk": "Arıza_Nedeni_İlk",
    "Arıza_Nedeni_Son": "Arıza_Nedeni_Son",
    "Arıza_Nedeni_Sık": "Arıza_Nedeni_Sık",
    "Neden_Değişim_Flag": "Neden_Değişim_Bayrağı",
    "Tek_Neden_Flag": "Tek_Neden_Bayrağı",
    "Çok_Nedenli_Flag": "Çok_Nedenli_Bayrağı",
    "Ekipman_Neden_Kombinasyonu": "Ekipman_Neden_Kombinasyonu",
    "Ekipman_Neden_Risk_Skoru": "Ekipman_Neden_Risk_Skoru",
    "Urban_Customer_Ratio_mean": "Kentsel_Müşteri_Oranı",
    "Rural_Customer_Ratio_mean": "Kırsal_Müşteri_Oranı",
    "MV_Customer_Ratio_mean": "OG_Müşteri_Oranı",
    "urban_lv_Avg": "Kentsel_AG_Müşteri_Ort",
    "urban_mv_Avg": "Kentsel_OG_Müşteri_Ort",
    "suburban_lv_Avg": "Yarıkentsel_AG_Müşteri_Ort",
    "suburban_mv_Avg": "Yarıkentsel_OG_Müşteri_Ort",
    "rural_lv_Avg": "Kırsal_AG_Müşteri_Ort",
    "rural_mv_Avg": "Kırsal_OG_Müşteri_Ort",
    "total_customer_count_Avg": "Toplam_Müşteri_Sayısı_Ort",
    "Avg_Customer_Count": "Ortalama_Müşteri_Sayısı",
    "Customer_Minutes_Risk_Annual": "Yıllık_Müşteri_Dakika_Riski",
    "Customer_Impact_Category": "Müşteri_Etki_Kategorisi",
    "İlçe": "İlçe",
    "Bölge_Tipi": "Bölge_Tipi",
    "X_KOORDINAT": "X_Koordinat",
    "Y_KOORDINAT": "Y_Koordinat",
    "Summer_Peak_Flag_sum": "Yaz_Pik_Toplam",
    "Winter_Peak_Flag_sum": "Kış_Pik_Toplam",
    "Son_Arıza_Mevsim": "Son_Arıza_Mevsimi",
    "Overdue_Factor": "Gecikme_Faktörü",
    "AgeRatio_Recurrence_Interaction": "Yaş_Tekrar_Etkileşimi",
    "Time_Since_Last_Normalized": "Son_Arıza_Normalize",
    "Failure_Free_3M": "Arızasız_3Ay_Bayrağı",
    "Ekipman_Yoğunluk_Skoru": "Ekipman_Yoğunluk_Skoru",
    "Tekrarlayan_Arıza_90gün_Flag": "Kronik_Arıza_Bayrağı",
    "Target_3M": "Hedef_3Ay",
    "Target_6M": "Hedef_6Ay",
    "Target_12M": "Hedef_12Ay",
    "PoF_Probability": "Arıza_Olasılığı",
    "Risk_Class": "Risk_Sınıfı",
    "Risk_Score": "Risk_Skoru",
    "Chronic_Probability": "Kronik_Olasılık",
    "Chronic_Class": "Kronik_Sınıf",
}

# Columns that selection never removes as constant or leaking.
PROTECTED = (
    "Ekipman_ID", "Equipment_Class_Primary", "component_voltage", "Voltage_Class", "Ekipman_Yaşı_Yıl",
    "Yas_Beklenen_Omur_Orani", "Beklenen_Ömür_Yıl", "Son_Arıza_Gun_Sayisi", "Time_To_Repair_Hours_mean",
    "Time_To_Repair_Hours_max", "MTBF_Gün", "MTBF_Degradation_Ratio", "MTBF_InterFault_Trend",
    "Arıza_Nedeni_Çeşitlilik", "Arıza_Nedeni_Tutarlılık", "Neden_Değişim_Flag", "Urban_Customer_Ratio_mean",
    "urban_lv_Avg", "urban_mv_Avg", "MV_Customer_Ratio_mean", "total_customer_count_Avg", "İlçe", "Bölge_Tipi",
    "Summer_Peak_Flag_sum", "Overdue_Factor", "Tekrarlayan_Arıza_90gün_Flag",
)

# Report category by exact display name; anything else is "Diğer".
CATEGORY_LISTS = {
    "Ekipman_Özellikleri": ("Ekipman_ID", "Ekipman_Sınıfı", "Ekipman_Tipi", "Gerilim_Seviyesi", "Gerilim_Sınıfı"),
    "Yaş_Ömür": ("Ekipman_Yaşı_Yıl", "Yaş_Ömür_Oranı", "Beklenen_Ömür_Yıl", "Yaş_Risk_Kategorisi"),
    "Arıza_Geçmişi": ("Toplam_Arıza_Sayısı", "Son_Arıza_Gün_Sayısı", "Onarım_Süresi_Ort_Saat", "Onarım_Süresi_Maks_Saat"),
    "Güvenilirlik_OAZS": ("OAZS_Gün", "OAZS_Bozulma_Oranı", "Arıza_Sıklık_Trendi", "OAZS_Değişkenlik_Oranı"),
    "Arıza_Nedenleri": ("Arıza_Nedeni_Çeşitlilik", "Arıza_Nedeni_Tutarlılık", "Neden_Değişim_Bayrağı"),
    "Müşteri_Etkisi": ("Kentsel_Müşteri_Oranı", "Kırsal_Müşteri_Oranı", "Toplam_Müşteri_Sayısı_Ort"),
    "Coğrafi": ("İlçe", "Bölge_Tipi", "Yaz_Pik_Toplam"),
    "Türetilmiş": ("Gecikme_Faktörü", "Yaş_Tekrar_Etkileşimi"),
}
OTHER_CATEGORY = "Diğer"
