"""What is measured: the game columns, and the metrics computed from them."""

from __future__ import annotations

from dataclasses import dataclass

from .fixed_values import FLASH_SPELL_ID, IMMORTAL_MIN_TAKEDOWNS, TEMPLATES


@dataclass(frozen=True)
class MetricSpec:
    """One tracked measure.

    ``expr`` is Spark SQL over the game columns; ``agg`` says whether a high
    (``max``) or a low (``min``) value is the better one.
    """

    name: str
    agg: str = "max"
    expr: str | None = None

    def __post_init__(self):
        if self.agg not in ("max", "min"):
            raise ValueError(f"{self.name}: agg must be max or min, not {self.agg}")

    @property
    def sql(self) -> str:
        return self.expr or self.name


# Short name of each raw column the metrics need.
GAME_COLUMNS = {
    "match_id": "metadata.matchId",
    "game_creation_ts": "info.gameCreation",
    "game_duration": "info.gameDuration",
    "champion_name": "participant.championName",
    "dmg_to_champs": "participant.totalDamageDealtToChampions",
    "dmg_total": "participant.totalDamageDealt",
    "dmg_turrets": "participant.damageDealtToTurrets",
    "dmg_objectives": "participant.damageDealtToObjectives",
    "gold_earned": "participant.goldEarned",
    "gold_spent": "participant.goldSpent",
    "kills": "participant.kills",
    "assists": "participant.assists",
    "deaths": "participant.deaths",
    "cs": "participant.totalMinionsKilled",
    "dragon_kills": "participant.dragonKills",
    "baron_kills": "participant.baronKills",
    "turret_kills": "participant.turretKills",
    "inhib_kills": "participant.inhibitorKills",
    "pinks": "participant.visionWardsBoughtInGame",
    "vision_score": "participant.visionScore",
    "cc_time": "participant.timeCCingOthers",
    "dmg_mitigated": "participant.damageSelfMitigated",
    "first_blood_kill": "participant.firstBloodKill",
    "triple_kills": "participant.tripleKills",
    "quadra_kills": "participant.quadraKills",
    "penta_kills": "participant.pentaKills",
    "heals_team": "participant.totalHealsOnTeammates",
    "shields_team": "participant.totalDamageShieldedOnTeammates",
    "longest_life": "participant.longestTimeSpentLiving",
    "obj_stolen": "participant.objectivesStolen",
    "obj_stolen_ast": "participant.objectivesStolenAssists",
    "wards_killed": "participant.wardsKilled",
    "wards_placed": "participant.wardsPlaced",
    "neutral_kills": "participant.neutralMinionsKilled",
    "phys_dmg": "participant.physicalDamageDealtToChampions",
    "magic_dmg": "participant.magicDamageDealtToChampions",
    "true_dmg": "participant.trueDamageDealtToChampions",
    "dmg_taken": "participant.totalDamageTaken",
    "largest_crit": "participant.largestCriticalStrike",
    "double_kills": "participant.doubleKills",
    "sprees": "participant.killingSprees",
    "enemy_jungle": "participant.totalEnemyJungleMinionsKilled",
    "spell1_id": "participant.summoner1Id",
    "spell1_casts": "participant.summoner1Casts",
    "spell2_id": "participant.summoner2Id",
    "spell2_casts": "participant.summoner2Casts",
    "time_dead": "participant.totalTimeSpentDead",
    "champ_level": "participant.champLevel",
}

_PER_SECOND = "nullif(game_duration, 0)"

# Computed metrics. Rates keep integer division (per second, truncated) and
# cspm keeps one decimal, as the stored records have them.
_COMPUTED = {
    "jungle_kills": "dragon_kills + baron_kills",
    "interceptor": "obj_stolen + obj_stolen_ast",
    "guard_angel": "heals_team + shields_team",
    "gold_unspent": "gold_earned - gold_spent",
    "immortal": f"int(coalesce(deaths = 0 and kills + assists >= {IMMORTAL_MIN_TAKEDOWNS}, false))",
    "flash_casts": (
        f"if(spell1_id = {FLASH_SPELL_ID}, spell1_casts, 0L)"
        f" + if(spell2_id = {FLASH_SPELL_ID}, spell2_casts, 0L)"
    ),
    "cspm": f"cast(round(cs * 60D / {_PER_SECOND}, 1) as decimal(22, 1))",
    "dpm": f"dmg_total div {_PER_SECOND}",
    "gpm": f"gold_earned div {_PER_SECOND}",
    "undying_ratio": f"time_dead div {_PER_SECOND}",
}

# The same rates as their message texts describe them: per minute, percent.
_REAL_RATES = {
    "cspm": f"cs * 60D / {_PER_SECOND}",
    "dpm": f"dmg_total * 60D / {_PER_SECOND}",
    "gpm": f"gold_earned * 60D / {_PER_SECOND}",
    "undying_ratio": f"time_dead * 100D / {_PER_SECOND}",
}

_LOW_IS_BETTER = {"undying_ratio"}


def match_metrics(rate_mode: str = "truncated") -> list[MetricSpec]:
    """The 43 metrics in message order; ``rate_mode`` is ``truncated`` or ``real``."""
    if rate_mode not in ("truncated", "real"):
        raise ValueError(f"unknown rate_mode {rate_mode}")
    computed = {**_COMPUTED, **(_REAL_RATES if rate_mode == "real" else {})}
    return [
        MetricSpec(name, "min" if name in _LOW_IS_BETTER else "max", computed.get(name))
        for name, _ in TEMPLATES
    ]
