SELECT tenant_id, DO_Piece AS NumPiece, strftime(DO_Date, '%d/%m/%Y') AS DateMouvement, AR_Ref AS CodeArticle,
  DL_Design AS LibelleArticle, DL_Qte AS Quantite, Sens, DL_MontantTTC AS Montant
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY tenant_id ORDER BY DO_Date DESC NULLS LAST, DO_Piece NULLS FIRST,
      AR_Ref NULLS FIRST, DL_Design NULLS FIRST, DL_Qte NULLS FIRST, Sens NULLS FIRST, DL_MontantTTC NULLS FIRST) AS rn
  FROM (
    SELECT *, CASE WHEN DO_Type = 20 THEN 'ENTRÉE' ELSE 'SORTIE' END AS Sens
    FROM doc_lines
    WHERE DO_Type IN (20, 21)
  ) AS moved
) AS ranked
WHERE rn <= 200
