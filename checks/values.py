"""Fixed values of the oracles, stated here a second time.

The oracles do not read the library's own, so a wrong value on either side shows.
"""

# --- fixed values: lists, labels and texts of the data contract ------------------
DEDUP_STEPS = ('Registros originais (RAW)',
 'Duplicidades completas removidas',
 'Duplicidades por customer_id removidas',
 'Registros após deduplicação determinística',
 'Candidatos a duplicidade aproximada (apenas investigação)')
GENDER_CATEGORIES = {'m': 'masculino',
 'masc': 'masculino',
 'masculino': 'masculino',
 'male': 'masculino',
 'f': 'feminino',
 'fem': 'feminino',
 'feminino': 'feminino',
 'female': 'feminino',
 'outro': 'outro',
 'nao binario': 'outro',
 'prefer not to say': 'outro',
 'n/i': 'outro'}
GENDER_DEFAULT = 'outro'
GENDER_TEST_PAIR = ('masculino', 'feminino')
KURTOSIS_LABELS = {'heavy': 'leptocúrtica (mais concentrada, com caudas mais pesadas que a normal)',
 'normal': 'mesocúrtica (próxima da distribuição normal)',
 'light': 'platicúrtica (mais achatada que a normal, caudas mais leves)'}
MEDIAN_SPLIT_LABELS = ('satisfação >= mediana', 'satisfação < mediana')
MISSING_TEXTS = {'global': 'mediana global (%.1f)',
 'group': 'mediana por grupo ({group}), fallback mediana global',
 'global_only': 'mediana global',
 'constant': "categoria 'unknown'"}
NA_TOKENS = ('',
 '#N/A',
 '#N/A N/A',
 '#NA',
 '-1.#IND',
 '-1.#QNAN',
 '-NaN',
 '-nan',
 '1.#IND',
 '1.#QNAN',
 '<NA>',
 'N/A',
 'NA',
 'NULL',
 'NaN',
 'None',
 'n/a',
 'nan',
 'null')
OUTLIER_ACTIONS = {'none': 'Nenhum outlier detectado — nenhuma ação necessária.',
 'low': 'Baixa incidência: manter os valores e investigar individualmente (podem ser clientes legítimos de alto '
        'valor).',
 'moderate': 'Incidência moderada: investigar a origem (erro de digitação vs. cliente atípico legítimo) antes de '
             'decidir entre manter, corrigir ou aplicar transformação (ex.: log) para análises sensíveis a escala.',
 'high': 'Alta incidência: reavaliar a regra de negócio ou o processo de coleta — um percentual tão alto de outliers '
         'pode indicar um problema sistemático de qualidade de dados, não apenas casos isolados.'}
PERCENTILES = (10, 25, 50, 75, 90, 95, 99)
QUALITY_TEXTS = {'completeness': "Percentual de valores preenchidos na coluna '{column}'.",
 'uniqueness': "Percentual de '%s' únicos (%d de %d registros; %d duplicados).",
 'validity_age': 'Percentual de idades dentro do intervalo válido (18-100).',
 'validity_email': 'Percentual de e-mails em formato válido (usuario@dominio.com).',
 'validity_satisfaction_score': 'Percentual de notas de satisfação dentro do intervalo esperado (1-5).',
 'validity_income_positive': 'Percentual de rendas com valor positivo (> 0).',
 'consistency_gender_categories': 'Percentual de registros com categoria de gênero padronizada.',
 'consistency_state_format': 'Percentual de registros com UF padronizada em 2 letras.',
 'consistency_purchase_vs_spent': "Percentual de registros consistentes entre 'purchase_count' e 'total_spent' (não "
                                  'deveria haver gasto sem nenhuma compra registrada).',
 'accuracy_note': 'Accuracy não pôde ser medida diretamente: não há uma fonte de dados externa e confiável (golden '
                  'record) para comparação. Em um cenário real, seria necessário validar contra um sistema de '
                  'referência (ex.: Receita Federal para CPF/e-mail, correios para endereço).'}
RANGE_STRATEGY = 'Convertido para ausente (NaN) e imputado pela mediana em handle_missing_values'
SEGMENT_TEST_PAIR = ('Medium Value', 'Low Value')
SKEW_LABELS = {'strong_right': 'fortemente assimétrica à direita (cauda longa de valores altos)',
 'mild_right': 'moderadamente assimétrica à direita',
 'symmetric': 'aproximadamente simétrica',
 'mild_left': 'moderadamente assimétrica à esquerda',
 'strong_left': 'fortemente assimétrica à esquerda (cauda longa de valores baixos)'}
STATE_DEFAULT = 'unknown'
STATE_NAMES = {'SP': 'sao paulo',
 'RJ': 'rio de janeiro',
 'MG': 'minas gerais',
 'BA': 'bahia',
 'RS': 'rio grande do sul',
 'PR': 'parana',
 'PE': 'pernambuco',
 'CE': 'ceara',
 'SC': 'santa catarina',
 'GO': 'goias',
 'DF': 'distrito federal',
 'ES': 'espirito santo',
 'PA': 'para',
 'AM': 'amazonas',
 'MT': 'mato grosso'}
STATUS_BAD = 'CRÍTICO'
STATUS_OK = 'OK'
STATUS_WARN = 'ATENÇÃO'
TEST_TEXTS = {'pearson': {'test': 'Pearson correlation ({x} x {y})',
             'h0': 'Não há correlação linear entre {x} e {y} (rho = 0)',
             'h1': 'Há correlação linear entre {x} e {y} (rho != 0)',
             'reject': 'Existe evidência estatística de correlação linear entre {x} e {y} (r=%.3f). Correlação não '
                       'implica causalidade.',
             'keep': 'Não há evidência estatística suficiente de correlação linear entre {x} e {y}.'},
 'spearman': {'test': 'Spearman correlation ({x} x {y})',
              'h0': 'Não há correlação monotônica entre {x} e {y} (rho = 0)',
              'h1': 'Há correlação monotônica entre {x} e {y} (rho != 0)',
              'reject': 'Existe evidência estatística de correlação monotônica entre {x} e {y} (rho=%.3f).',
              'keep': 'Não há evidência estatística suficiente de correlação monotônica entre {x} e {y}.'},
 'welch': {'test': 'Independent T-Test ({value}: {a} vs {b})',
           'h0': "A média de {value} é igual entre os grupos '{a}' e '{b}'",
           'h1': "A média de {value} é diferente entre os grupos '{a}' e '{b}'",
           'reject': "As médias de {value} diferem significativamente entre os grupos '{a}' (média=%.2f) e '{b}' "
                     '(média=%.2f).',
           'keep': "Não há evidência estatística suficiente de diferença entre as médias de {value} nos grupos '{a}' "
                   "e '{b}'."},
 'mann_whitney': {'test': 'Mann-Whitney U ({value}: {a} vs {b})',
                  'h0': "As distribuições de {value} são iguais entre os grupos '{a}' e '{b}'",
                  'h1': "As distribuições de {value} diferem entre os grupos '{a}' e '{b}'",
                  'reject': "As distribuições de {value} diferem significativamente entre os grupos '{a}' "
                            "(mediana=%.2f) e '{b}' (mediana=%.2f).",
                  'keep': 'Não há evidência estatística suficiente de diferença entre as distribuições de {value} '
                          "nos grupos '{a}' e '{b}'."},
 'anova': {'test': 'ANOVA one-way ({value} by {group})',
           'h0': 'A média de {value} é igual entre todos os grupos de {group}',
           'h1': 'A média de {value} difere entre pelo menos dois grupos de {group}',
           'reject': 'Há diferença estatisticamente significativa na média de {value} entre pelo menos dois grupos '
                     'de {group}. Testes post-hoc (ex.: Tukey HSD) seriam necessários para identificar quais pares '
                     'diferem.',
           'keep': 'Não há evidência estatística suficiente de diferença na média de {value} entre os grupos de '
                   '{group}.'}}
