"""Values that results depend on literally: column names, templates, formats.

Nothing here is logic. Operators take these as defaults and accept others.
"""

from __future__ import annotations

# The six columns every match document must have.
META_COLUMNS = [
    ("metadata.matchId", "string"),
    ("info.gameCreation", "bigint"),
    ("info.gameDuration", "bigint"),
    ("info.gameMode", "string"),
    ("info.queueId", "bigint"),
    ("info.gameVersion", "string"),
]

# The fields of one participant, in table order.
PARTICIPANT_FIELDS = [
    ("PlayerScore0", "bigint"),
    ("PlayerScore1", "bigint"),
    ("PlayerScore10", "bigint"),
    ("PlayerScore11", "bigint"),
    ("PlayerScore2", "bigint"),
    ("PlayerScore3", "bigint"),
    ("PlayerScore4", "bigint"),
    ("PlayerScore5", "bigint"),
    ("PlayerScore6", "bigint"),
    ("PlayerScore7", "bigint"),
    ("PlayerScore8", "bigint"),
    ("PlayerScore9", "bigint"),
    ("allInPings", "bigint"),
    ("assistMePings", "bigint"),
    ("assists", "bigint"),
    ("baronKills", "bigint"),
    ("basicPings", "bigint"),
    ("challenges", "map<string,double>"),
    ("missions", "map<string,bigint>"),
    ("champExperience", "bigint"),
    ("champLevel", "bigint"),
    ("championId", "bigint"),
    ("championName", "string"),
    ("championSkinId", "bigint"),
    ("championTransform", "bigint"),
    ("commandPings", "bigint"),
    ("consumablesPurchased", "bigint"),
    ("damageDealtToBuildings", "bigint"),
    ("damageDealtToObjectives", "bigint"),
    ("damageDealtToTurrets", "bigint"),
    ("damageSelfMitigated", "bigint"),
    ("dangerPings", "bigint"),
    ("deaths", "bigint"),
    ("detectorWardsPlaced", "bigint"),
    ("doubleKills", "bigint"),
    ("dragonKills", "bigint"),
    ("eligibleForProgression", "boolean"),
    ("enemyMissingPings", "bigint"),
    ("enemyVisionPings", "bigint"),
    ("firstBloodAssist", "boolean"),
    ("firstBloodKill", "boolean"),
    ("firstTowerAssist", "boolean"),
    ("firstTowerKill", "boolean"),
    ("gameEndedInEarlySurrender", "boolean"),
    ("gameEndedInSurrender", "boolean"),
    ("getBackPings", "bigint"),
    ("goldEarned", "bigint"),
    ("goldSpent", "bigint"),
    ("holdPings", "bigint"),
    ("individualPosition", "string"),
    ("inhibitorKills", "bigint"),
    ("inhibitorTakedowns", "bigint"),
    ("inhibitorsLost", "bigint"),
    ("item0", "bigint"),
    ("item1", "bigint"),
    ("item2", "bigint"),
    ("item3", "bigint"),
    ("item4", "bigint"),
    ("item5", "bigint"),
    ("item6", "bigint"),
    ("itemsPurchased", "bigint"),
    ("killingSprees", "bigint"),
    ("kills", "bigint"),
    ("lane", "string"),
    ("largestCriticalStrike", "bigint"),
    ("largestKillingSpree", "bigint"),
    ("largestMultiKill", "bigint"),
    ("longestTimeSpentLiving", "bigint"),
    ("magicDamageDealt", "bigint"),
    ("magicDamageDealtToChampions", "bigint"),
    ("magicDamageTaken", "bigint"),
    ("needVisionPings", "bigint"),
    ("neutralMinionsKilled", "bigint"),
    ("nexusKills", "bigint"),
    ("nexusLost", "bigint"),
    ("nexusTakedowns", "bigint"),
    ("objectivesStolen", "bigint"),
    ("objectivesStolenAssists", "bigint"),
    ("onMyWayPings", "bigint"),
    ("participantId", "bigint"),
    ("pentaKills", "bigint"),
    ("perks", "perks"),
    ("physicalDamageDealt", "bigint"),
    ("physicalDamageDealtToChampions", "bigint"),
    ("physicalDamageTaken", "bigint"),
    ("placement", "bigint"),
    ("playerAugment1", "bigint"),
    ("playerAugment2", "bigint"),
    ("playerAugment3", "bigint"),
    ("playerAugment4", "bigint"),
    ("playerAugment5", "bigint"),
    ("playerAugment6", "bigint"),
    ("playerSubteamId", "bigint"),
    ("profileIcon", "bigint"),
    ("pushPings", "bigint"),
    ("puuid", "string"),
    ("quadraKills", "bigint"),
    ("retreatPings", "bigint"),
    ("riotIdGameName", "string"),
    ("riotIdTagline", "string"),
    ("role", "string"),
    ("sightWardsBoughtInGame", "bigint"),
    ("spell1Casts", "bigint"),
    ("spell2Casts", "bigint"),
    ("spell3Casts", "bigint"),
    ("spell4Casts", "bigint"),
    ("subteamPlacement", "bigint"),
    ("summoner1Casts", "bigint"),
    ("summoner1Id", "bigint"),
    ("summoner2Casts", "bigint"),
    ("summoner2Id", "bigint"),
    ("summonerId", "string"),
    ("summonerLevel", "bigint"),
    ("summonerName", "string"),
    ("teamEarlySurrendered", "boolean"),
    ("teamId", "bigint"),
    ("teamPosition", "string"),
    ("timeCCingOthers", "bigint"),
    ("timePlayed", "bigint"),
    ("totalAllyJungleMinionsKilled", "bigint"),
    ("totalDamageDealt", "bigint"),
    ("totalDamageDealtToChampions", "bigint"),
    ("totalDamageShieldedOnTeammates", "bigint"),
    ("totalDamageTaken", "bigint"),
    ("totalEnemyJungleMinionsKilled", "bigint"),
    ("totalHeal", "bigint"),
    ("totalHealsOnTeammates", "bigint"),
    ("totalMinionsKilled", "bigint"),
    ("totalTimeCCDealt", "bigint"),
    ("totalTimeSpentDead", "bigint"),
    ("totalUnitsHealed", "bigint"),
    ("tripleKills", "bigint"),
    ("trueDamageDealt", "bigint"),
    ("trueDamageDealtToChampions", "bigint"),
    ("trueDamageTaken", "bigint"),
    ("turretKills", "bigint"),
    ("turretTakedowns", "bigint"),
    ("turretsLost", "bigint"),
    ("unrealKills", "bigint"),
    ("visionClearedPings", "bigint"),
    ("visionScore", "bigint"),
    ("visionWardsBoughtInGame", "bigint"),
    ("wardsKilled", "bigint"),
    ("wardsPlaced", "bigint"),
    ("win", "boolean"),
]

# Message texts by metric; their order is the message order.
TEMPLATES = [
    ("dmg_to_champs", '{nickname}, потрясающе! В матче {matchId} на {champion} ты нанёс {value} урона по чемпионам — твой лучший результат за последнюю неделю.'),
    ("dmg_total", '{nickname}, настоящая армия урона! {value} суммарного урона в матче {matchId} на {champion} — выше всех твоих игр за неделю.'),
    ("dmg_turrets", '{nickname}, башни дрожали! В матче {matchId} на {champion} ты нанёс {value} урона по башням — новый максимум недели.'),
    ("dmg_objectives", '{nickname}, охотник на цели! {value} урона по объективам в матче {matchId} на {champion} — лучший показатель за неделю.'),
    ("gold_earned", '{nickname}, золотая жила! {value} золота в матче {matchId} на {champion} — больше, чем в любой игре за неделю.'),
    ("kills", '{nickname}, машина убийств! {value} киллов в матче {matchId} на {champion} — рекорд недели.'),
    ("assists", '{nickname}, герой поддержки! {value} ассистов в матче {matchId} на {champion} — лучший командный вклад за неделю.'),
    ("cs", '{nickname}, фермер‑профи! {value} добитых миньонов в матче {matchId} на {champion} — лучший фарм недели.'),
    ("jungle_kills", '{nickname}, властелин нейтралов! {value} баронов и драконов в матче {matchId} на {champion} — новый максимум недели.'),
    ("turret_kills", '{nickname}, разрушитель! Ты снёс {value} башен в матче {matchId} на {champion} — лучший результат недели.'),
    ("inhib_kills", '{nickname}, ломатель ингибов! {value} ингибиторов в матче {matchId} на {champion} — рекорд недели.'),
    ("pinks", '{nickname}, властелин вижна! {value} контроль‑вардов куплено в матче {matchId} на {champion} — максимум недели.'),
    ("vision_score", '{nickname}, светоч карты! Vision Score {value} в матче {matchId} на {champion} — выше, чем когда‑либо за неделю.'),
    ("cc_time", '{nickname}, мастер контроля! {value} секунд CC в матче {matchId} на {champion} — лучший показатель недели.'),
    ("dmg_mitigated", '{nickname}, железная стена! Ты поглотил {value} урона в матче {matchId} на {champion} — новый личный максимум за неделю.'),
    ("first_blood_kill", '{nickname}, стремительный старт! Ты взял First Blood в матче {matchId} на {champion} — редкое достижение за неделю.'),
    ("immortal", '{nickname}, безупречно! Ты закончил матч {matchId} на {champion} без смертей — первый такой за неделю.'),
    ("triple_kills", '{nickname}, трипл‑шторм! {value} Triple Kills в матче {matchId} на {champion} — рекорд недели.'),
    ("quadra_kills", '{nickname}, квадра‑герой! {value} Quadra Kills в матче {matchId} на {champion} — лучший показатель недели.'),
    ("penta_kills", '{nickname}, PENTAKILL! Ты сделал пенту в матче {matchId} на {champion} — первая за последнюю неделю.'),
    ("heals_team", '{nickname}, целитель! Ты восстановил союзникам {value} здоровья в матче {matchId} на {champion} — рекорд недели.'),
    ("shields_team", '{nickname}, непробиваемый! Ты подарил щитов на {value} урона в матче {matchId} на {champion} — лучший вклад недели.'),
    ("longest_life", '{nickname}, феникс! Ты прожил {value} с без смерти в матче {matchId} на {champion} — самая длинная жизнь недели.'),
    ("cspm", '{nickname}, CS‑машина! Фарм {value} CS/мин в матче {matchId} на {champion} — рекорд недели.'),
    ("interceptor", '{nickname}, король стилов! {value} украденных целей в матче {matchId} на {champion} — новый максимум недели.'),
    ("wards_killed", '{nickname}, охотник на варды! Ты уничтожил {value} вардов в матче {matchId} на {champion} — лучший результат недели.'),
    ("wards_placed", '{nickname}, проводник света! Ты поставил {value} вардов в матче {matchId} на {champion} — рекорд недели.'),
    ("dpm", '{nickname}, метеорит! DPM {value} в матче {matchId} на {champion} — самый высокий за неделю.'),
    ("gpm", '{nickname}, банкир! GPM {value} в матче {matchId} на {champion} — лучший финансовый темп недели.'),
    ("enemy_jungle", '{nickname}, лесной захватчик! Ты выфармил {value} вражеских крипов в матче {matchId} на {champion} — рекорд недели.'),
    ("neutral_kills", '{nickname}, лорд нейтралов! Ты забрал {value} нейтралов в матче {matchId} на {champion} — новый максимум недели.'),
    ("phys_dmg", '{nickname}, физ‑гром! {value} физического урона в матче {matchId} на {champion} — рекорд недели.'),
    ("magic_dmg", '{nickname}, магистр арканы! {value} магического урона в матче {matchId} на {champion} — лучший результат недели.'),
    ("true_dmg", '{nickname}, истинный калибр! {value} true‑урона в матче {matchId} на {champion} — новый максимум недели.'),
    ("dmg_taken", '{nickname}, тяжёлый танк! Ты принял {value} урона в матче {matchId} на {champion} — больше, чем когда‑либо за неделю.'),
    ("largest_crit", '{nickname}, легенда критов! Крит на {value} в матче {matchId} на {champion} — самый мощный за неделю.'),
    ("double_kills", '{nickname}, двойной удар! {value} Double Kills в матче {matchId} на {champion} — рекорд недели.'),
    ("sprees", '{nickname}, снежный ком! Серия из {value} убийств в матче {matchId} на {champion} — самый длинный стрик недели.'),
    ("gold_unspent", '{nickname}, скряга! Ты закончил матч {matchId} на {champion} с {value} непр потраченного золота — необычный рекорд недели.'),
    ("flash_casts", '{nickname}, флэш‑боец! Ты использовал «Вспышку» {value} раз в матче {matchId} на {champion} — больше, чем в любой игре недели.'),
    ("undying_ratio", '{nickname}, почти бессмертен! Всего {value}% времени в смерти в матче {matchId} на {champion} — лучший показатель недели.'),
    ("champ_level", '{nickname}, мастер опыта! Ты достиг уровня {value} в матче {matchId} на {champion} — выше, чем в любых играх за неделю.'),
    ("guard_angel", '{nickname}, ангел-хранитель! Общее лечение + щиты {value} в матче {matchId} на {champion} — лучший вклад в команду за неделю.'),
]

# Separators, placeholders and formats.
META_SEPARATOR = "-_-"
UNKNOWN_MATCH = "<match>"
UNKNOWN_CHAMPION = "<champion>"
MATCH_ID_PREFIX = "RU_"
MATCH_LINK = '<a href="https://www.leagueofgraphs.com/match/ru/%s">%s</a>'
PLAYER_LINK = "https://www.leagueofgraphs.com/summoner/ru/%s"
FLASH_SPELL_ID = 4
IMMORTAL_MIN_TAKEDOWNS = 10
LOOKBACK_DAYS = 31
WEEKS_BACK = 5
MESSAGES_PER_CHAMPION = 3
MATCHES_PER_PLAYER_DAY = 100
INGEST_DAYS = 7
STALE_AFTER_SECONDS = 6 * 3600
