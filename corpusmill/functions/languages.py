"""Frequent words by language, which readable text must have."""

PT = """de que a o e do da em um para com não nao uma os no se na por mais as dos como mas ao das à pelo pela ou quando muito nos já ja
também tambem só so seu sua ser são sao foi há ha entre depois sem mesmo aos isso ela ele esse essa este esta está pode sobre qual quais
texto questão questao alternativa""".split()
EN = "the of and to is in".split()
DE = "der die das und in zu den von ist mit sich des auf für im dem nicht ein eine als auch es an".split()
FR = "de la le et les des en un du une que est pour qui dans sur pas par au avec plus ce la".split()
ES = "de la que el en y a los se del las un por con no una su para es al lo como más".split()
STOP = {"pt": sorted(set(PT)), "en": sorted({*EN, "a", "that", "it", "for", "was", "on", "are", "as", "with", "at", "be", "this", "by", "an", "he", "from"}), "de": sorted(set(DE)), "fr": sorted(set(FR)), "es": sorted(set(ES))}
