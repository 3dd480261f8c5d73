"""Problem 2 on messages that were worded after the grammar was written and stand in none of the test tables."""

from pathlib import Path

import pytest

from codexmill.llm import residue

DATA = Path("/root/testdata/sf0.01/localizations.parquet")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")
MESSAGES = """Diese Seite existiert leider nicht mehr.
El contenido ha sido eliminado.
この記事は削除されました。
HTTP/1.1 418 I'm a teapot
Sorry, that page has been removed by its owner.
The book you requested could not be loaded. Please try again later.
We couldn't find the page you were looking for.
Error 503: the server is temporarily overloaded
Your session has timed out, please log in again.
You don't have permission to open this document.
This content isn't available in your country right now.
Our website is undergoing scheduled maintenance.
Connection to the database failed.
TypeError: Cannot read property 'length' of undefined
Please switch on JavaScript to read this chapter.
JavaScript must be enabled to show this page
Verifying that you are not a robot...
Your browser is too old to display this site.
Insert a short summary here
No synopsis has been provided yet.
Description will be added soon
Sample text, please replace before publishing
{{ book.subtitle }}
${product_name}
%author_name%
<%= summary %>
[Insert author biography here]
抱歉，该作品已经下架了。
您要找的网页已被移除。
网络异常，请检查后重试
系统正在升级维护中，请稍后再试。
请先开启浏览器的JavaScript功能
本书暂无任何简介
请在此处输入作品简介
ご指定のコンテンツは現在表示できません。
通信エラーが発生しました。時間をおいて再度お試しください。
このサイトを利用するにはCookieを有効にしてください
あらすじはまだ登録されていません
해당 페이지는 삭제되었거나 존재하지 않습니다.
일시적인 오류가 발생했습니다. 다시 시도해 주세요.
브라우저에서 자바스크립트를 켜 주세요.
작품 소개가 아직 등록되지 않았습니다
Der Artikel wurde gelöscht oder verschoben.
Leider ist ein Fehler aufgetreten. Bitte versuchen Sie es noch einmal.
Bitte schalten Sie JavaScript in Ihrem Browser ein.
Noch keine Inhaltsangabe verfügbar
Désolé, cette page n'existe plus.
Une erreur inattendue s'est produite, veuillez réessayer.
Vous devez activer les cookies pour poursuivre
Résumé bientôt disponible
Lo sentimos, la página ya no está disponible.
Ha ocurrido un error inesperado en el servidor.
Debe activar JavaScript para ver el contenido
Todavía no hay sinopsis para este libro
К сожалению, эта страница больше не существует.
Произошла неизвестная ошибка, повторите попытку позже.
Чтобы продолжить, разрешите файлы cookie в браузере
Аннотация появится позднее""".split("\n")
PROSE = """The clerk wrote four hundred and four letters and never sent the last of them.
When the page turned pale the prince asked for his horse.
Nobody had permission to cross the bridge after dark, and the guard slept.
A mistake in the ledger cost the baker his house.
Он написал страницу за страницей, пока не погасла лампа.
Niemand wusste, warum die Brücke im Winter verschwand.
La gardienne du phare ferma le livre et sortit sous la pluie.
El servidor del rey llegó tarde a la cena.
老人把那本书放在桌上，没有再说一句话。
灯台守の娘は、雪の夜に古い手紙を燃やした。
노인은 다리를 건너며 오래된 약속을 떠올렸다.
She enabled the old lock with a hairpin and smiled.
The error was hers, and the service in the inn was slow.
He taught JavaScript to sailors who had never seen a screen.""".split("\n")


@pytest.fixture(scope="module")
def told(spark):
    """Which of some texts are residue, by the models of a catalog."""
    catalog = spark.read.parquet(str(DATA))

    def tell(parts):
        model = residue.fitted(residue.raw_texts(catalog.repartition(parts)))
        out = []
        for text in MESSAGES + PROSE:
            low, at = residue.folded([text + "\n"])
            out.append(bool(residue.judge(text, model.places(low, at)[: at[1] - 1])))
        return out

    return tell


def test_held_out_messages(told):
    found = told(4)
    missed = [m for m, bad in zip(MESSAGES, found, strict=False) if not bad]
    assert len(missed) <= 0.1 * len(MESSAGES), missed
    # the catalog hardly knows the words of these sentences, so they are harder than its own texts
    assert sum(found[len(MESSAGES) :]) <= 2


def test_models_do_not_depend_on_partitions(spark, told):
    assert told(1) == told(16)
    raw = residue.raw_texts(spark.read.parquet(str(DATA)))
    heavy = residue.recurring(raw)
    one, many = (residue.prose_counts(raw.repartition(n), residue.recurring(raw.repartition(n))) for n in (1, 16))
    assert (one == many).all() and len(heavy) <= 1 / residue.HEAVY
