-- Relations that several reports are written over.
-- doc_lines: every line whose document exists, with that document's date and party.
doc_lines AS (
  SELECT * FROM F_DOCENTETE JOIN F_DOCLIGNE USING (tenant_id, DO_Piece, DO_Type)
),
-- sold_lines: the lines of invoices and credit notes; sold_items: with the item's own data, if it is known.
sold_lines AS (
  SELECT * FROM doc_lines WHERE DO_Type IN (6, 7)
),
sold_items AS (
  SELECT * FROM sold_lines LEFT JOIN F_ARTICLE USING (tenant_id, AR_Ref)
),
-- doc_totals: one row per document that has lines.
doc_totals AS (
  SELECT tenant_id, DO_Piece, DO_Type, DO_Date, DO_Tiers, SUM(DL_MontantTTC) AS total
  FROM doc_lines
  GROUP BY tenant_id, DO_Piece, DO_Type, DO_Date, DO_Tiers
),
-- invoice_rows: the lines of sales invoices; an invoice without lines is one row without amount.
invoice_rows AS (
  SELECT tenant_id, DO_Tiers, DL_MontantTTC
  FROM F_DOCENTETE LEFT JOIN F_DOCLIGNE USING (tenant_id, DO_Piece, DO_Type)
  WHERE DO_Type = 7
),
party AS (
  SELECT tenant_id, CT_Num AS DO_Tiers, CT_Intitule AS party_name FROM F_COMPTET
),
-- payer_rows: payments by the party that pays; day_receipts: their total per calendar day.
payer_rows AS (
  SELECT tenant_id, CT_NumPayeur AS DO_Tiers, RG_Montant FROM F_CREGLEMENT
),
day_receipts AS (
  SELECT tenant_id, CAST(RG_Date AS DATE) AS calendar_day, SUM(RG_Montant) AS received
  FROM F_CREGLEMENT
  GROUP BY tenant_id, CAST(RG_Date AS DATE)
),
-- Fixed values: the published names of payment modes.
mode_names AS (
  SELECT * FROM (VALUES (0, 'Espèces'), (1, 'Chèque'), (2, 'Carte'), (3, 'Virement')) AS m(N_Reglement, mode_name)
),
-- latest_sales: the sales report with its rank, for the report and for its payload.
latest_sales AS (
  SELECT tenant_id, rn, DO_Piece AS NumFacture, strftime(DO_Date, '%d/%m/%Y') AS DateFacture, DO_Tiers AS CodeClient,
    coalesce(party_name, 'CLIENT INCONNU') AS NomClient, CAST(total AS DECIMAL(18,2)) AS MONTANT_TTC,
    CASE WHEN DO_Type = 7 THEN 'FACTURE' ELSE 'AVOIR' END AS TypeDoc
  FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY tenant_id
      ORDER BY DO_Date DESC NULLS LAST, DO_Piece DESC NULLS LAST, DO_Type NULLS FIRST) AS rn
    FROM doc_totals WHERE DO_Type IN (6, 7)
  ) AS ranked
  LEFT JOIN party USING (tenant_id, DO_Tiers)
  WHERE rn <= 200
)
