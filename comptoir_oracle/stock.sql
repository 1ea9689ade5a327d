SELECT tenant_id, AR_Ref AS CodeArticle, AR_Design AS LibelleArticle, AS_QteSto AS QuantiteStock, AS_MontSto AS MontantStock
FROM F_ARTSTOCK JOIN F_ARTICLE USING (tenant_id, AR_Ref)
WHERE AS_QteSto <> 0
