SELECT tenant_id, part, CAST(MAX(part + 1) OVER (PARTITION BY tenant_id) AS INT) AS n_parts, data
FROM (
  SELECT tenant_id, CAST(FLOOR((place - 1) / 500) AS INT) AS part,
    to_json(list(struct_pack(CodeArticle := AR_Ref, LibelleArticle := AR_Design,
                             QuantiteStock := CAST(AS_QteSto AS VARCHAR), MontantStock := CAST(AS_MontSto AS VARCHAR))
                 ORDER BY place)) AS data
  FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY tenant_id
      ORDER BY AR_Ref NULLS FIRST, AS_QteSto NULLS FIRST, AS_MontSto NULLS FIRST) AS place
    FROM F_ARTSTOCK JOIN F_ARTICLE USING (tenant_id, AR_Ref)
    WHERE AS_QteSto <> 0
  ) AS placed
  GROUP BY tenant_id, FLOOR((place - 1) / 500)
) AS parts
